"""Quality rules: base counts, and how far a text's histograms are from its language.

Two histograms are taken of every text: its characters by class, and its
common words (``COMMON``; all other words are one more bin). The reference of
a language is the sum of the histograms of all its texts that pass the base
rules, so it covers the whole table. A text is rejected if the Jensen-Shannon
distance (square root of the divergence in bits) to the reference of its
language is above a threshold. Each test has a guard: texts too short for a
histogram to mean anything are not judged by it.

Everything is built-in functions. The texts are read once; what is stored in
between are counts, and the references are one row per language of ``COMMON``
and one for the rest, so broadcasting them has a fixed bound.

Defined results: a null text is an empty one (no words, fails the base rules);
a null or unknown language shares one reference, on which only the character
test is done; repeated rows are judged row by row; an empty table gives an
empty result; other columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm.common import words
from clickweir.workspace import materialise

# Frequent function words of each language.
COMMON = {
    "en": "the of and to in is that for it with as was on be by are this from or an".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas plus avec".split(),
    "es": "de la que el en y a los se del las un por con una su para es al lo".split(),
}
SYMBOLS = r"[^#*$%&|<>]+"
# Every character outside the class, in runs; what is left after removing them is the class.
CLASSES = {"upper": r"\P{Lu}+", "digit": r"[^0-9]+", "stop": r"[^.,;:!?]+"}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _left(text: Column, others: str) -> Column:
    return F.char_length(F.regexp_replace(text, others, "")).cast("long")


def base_counts(docs: DataFrame, doc_id="doc_id", text="text", lang="lang", keep=()) -> DataFrame:
    """Base counts and both histograms of every text; ``keep`` names columns to carry along.

    Character bins: the classes, symbols, white space, all the rest.
    """
    df = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("kept_columns")
        if keep
        else F.lit(True).alias("kept_columns"),
        F.col(doc_id).alias("doc_id"),
        F.when(F.col(lang).isin(*COMMON), F.col(lang)).otherwise(F.lit("other")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("t"),
    )
    df = df.withColumn("w", words(F.col("t")))
    n = F.size("w")
    window = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)),
    )
    every = sorted({x for xs in COMMON.values() for w in xs for x in (w, w.capitalize())})
    df = df.select(
        "*",
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.when(n >= 3, window).otherwise(F.array().cast("array<bigint>")).alias("h"),
        F.transform(F.filter("w", lambda x: x.isin(*every)), F.lower).alias("common"),
    )
    # Only texts in which some window comes twice pay for the sort by window.
    same = F.size(F.array_distinct("h")) == F.size("h")
    df = df.withColumn(
        "by_window",
        F.when(same, None).otherwise(
            F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ),
    )

    def twice(x: Column, i: Column) -> Column:
        before, after = F.get("by_window", i - 1)["h"], F.get("by_window", i + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(
            x["h"] == after, F.lit(False)
        )

    hits = F.transform(F.filter("by_window", twice), lambda x: x["i"])
    covered = F.array_distinct(
        F.flatten(F.transform(hits, lambda i: F.array(i, i + 1, i + 2)))
    )
    listed = F.lit(None).cast("array<string>")
    for name, xs in COMMON.items():
        listed = F.when(F.col("lang") == name, F.array(*map(F.lit, xs))).otherwise(listed)
    df = df.withColumn("listed", listed)
    classes = [_left(F.col("t"), others).alias(name) for name, others in CLASSES.items()]
    n_common = F.size("common")
    counted = df.select(
        "kept_columns",
        "doc_id",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _left(F.col("t"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.char_length("t").cast("long").alias("n_chars"),
        F.struct(*classes).alias("classes"),
        # Occurrences of each listed word, by its place in the list.
        F.transform(
            "listed", lambda x: (n_common - F.size(F.array_remove("common", x))).cast("long")
        ).alias("common_counts"),
    )


    # Both histograms end with the bin of all the rest.
    found = [F.col(f"classes.{c}") for c in CLASSES]
    found += [F.col("n_symbols"), F.col("n_chars") - F.col("word_chars")]
    rest = F.col("n_chars") - sum(found, F.lit(0).cast("long"))
    add = F.aggregate("common_counts", F.lit(0).cast("long"), lambda a, x: a + x)
    return counted.select(
        *[c for c in counted.columns if c not in ("classes", "common_counts")],
        F.array(*found, rest).alias("chars"),
        F.concat("common_counts", F.array(F.col("n_words") - add)).alias("common"),
        (
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
        ).alias("base_failed"),
    )


def _js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts, 0 to 1."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def shares(x: Column) -> Column:
        return F.transform(x, lambda v: v / total(x))

    terms = F.zip_with(
        shares(p), shares(q), lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2)
    )
    return F.sqrt(F.greatest(total(terms) / 2, F.lit(0.0)))


def references(binned: DataFrame) -> DataFrame:
    """Summed histograms per language over all texts that pass the base rules.

    At most one row per language of ``COMMON`` and one for the rest.
    """
    bins = max(len(x) for x in COMMON.values()) + 1

    def sums(column: str, size: int) -> Column:
        return F.filter(
            F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(size)]),
            lambda x: x.isNotNull(),
        )

    return (
        binned.where(~F.col("base_failed"))
        .groupBy("lang")
        .agg(
            sums("chars", len(CLASSES) + 3).alias("ref_chars"),
            sums("common", bins).alias("ref_common"),
        )
    )


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    keep: Sequence[str] = (),
    max_chars_distance: float = 0.3,
    max_common_distance: float = 0.25,
    min_chars: int = 300,
    min_words: int = 150,
) -> DataFrame:
    """Base counts, both distances (null where the guard holds) and the verdict of every row.

    ``keep`` names columns of ``docs`` that come along in ``kept_columns``.
    """
    # It stays while the result is read, whole texts with it if they are kept.
    counted = materialise(base_counts(docs, doc_id, text, lang, keep), compression="zstd")
    refs = F.broadcast(references(counted))
    joined = counted.join(refs, "lang", "left")
    chars = F.when(
        (F.col("n_chars") >= min_chars) & F.col("ref_chars").isNotNull(),
        _js_distance(F.col("chars"), F.col("ref_chars")),
    )
    common = F.when(
        (F.col("n_words") >= min_words) & F.col("ref_common").isNotNull() & (F.size("common") > 0),
        _js_distance(F.col("common"), F.col("ref_common")),
    )
    judged = joined.withColumns({"chars_distance": chars, "common_distance": common})
    far = (F.coalesce("chars_distance", F.lit(0.0)) > max_chars_distance) | (
        F.coalesce("common_distance", F.lit(0.0)) > max_common_distance
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~far).drop(
        "chars", "common", "ref_chars", "ref_common", "lang"
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows the rules reject; same columns."""
    judged = judge(docs, keep=docs.columns, **options)
    return judged.where("kept").select("kept_columns.*")

