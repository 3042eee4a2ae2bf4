"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of ``window`` words (an item of fewer words is one
window); a window is contained in a document if its words stand there one after
the other. A window is a set of shingles at fixed offsets. All of them must be
in a document that contains the window, so its necessary prefix is one shingle,
and the cheapest is the one that is rarest in the documents:

1. Shingles of documents that are shingles of some window are found with one
   pass over the texts and stored with their positions.
2. Windows with a shingle that no document has are done. The others are joined
   by their rarest shingle. Its offset gives the start of the window, which
   must lie within the document with all its words (position and length bound).
3. A candidate is verified shingle by shingle over the whole window: shingles
   are compared as text, so containment is exact.

The benchmark side is broadcast only after its rows and bytes were measured;
beyond the bound the joins are sort-merge joins, which adaptive execution
splits under skew. What is stored grows with the matches, not with the texts.

Defined results: null texts have no words; a null item id is dropped from the
list of items, its windows still count; items of the same id are one item;
repeated rows get equal results, one each; empty tables on either side give no
hits; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.common import ascii_lower, fresh
from clickweir.operators.joins import fits_broadcast
from clickweir.workspace import materialise, settle

# Everything but digits, a-z and what is not ASCII, in texts already in lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Not a character of any word, so it is no shingle.
MARK = "\x00"


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df.hint("merge")


def item_windows(
    benchmark: DataFrame, item_id: str, text: str, window: int
) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (wid, words, n), and the items (wid, item) each is from."""
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), word_list(F.col(text)).alias("w")
    ).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("w") - n + 1)
    cut = items.select(
        "item", F.explode(F.transform(starts, lambda i: F.slice("w", i, n))).alias("words")
    )
    cut = materialise(cut.distinct())
    windows = materialise(
        cut.select("words").distinct().select(
            F.monotonically_increasing_id().alias("wid"), "words", F.size("words").alias("n")
        )
    )
    return windows, materialise(cut.join(windows, "words").select("wid", "item").distinct())


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    shingle: int = 3,
    parts: int = 20,
) -> DataFrame:
    """One row per document: its words, hit words, items, and whether it is contaminated.

    Contaminated: some word is hit, and at least one in ``parts``. ``text_hash``
    tells rows of one id apart.
    """
    given = (docs, benchmark, doc_id, text, item_id, item_text, window, shingle, parts)
    return settle(docs.sparkSession, lambda: _judged(*given))


def _judged(docs, benchmark, doc_id, text, item_id, item_text, window, shingle, parts):
    windows, window_items = item_windows(benchmark, item_id, item_text, window)
    grams = materialise(
        windows.withColumn("g", F.least("n", F.lit(shingle)))
        .withColumn("off", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("g"))))
        .select(
            "wid",
            "n",
            "g",
            "off",
            F.array_join(F.slice("words", F.col("off") + 1, F.col("g")), " ").alias("gram"),
        )
    )
    # At most ``shingle`` different lengths.
    lengths = [r[0] for r in grams.select("g").distinct().collect()]
    hits = materialise(_hits(docs, grams, doc_id, text, lengths))
    marks = hits.where(F.col("gram") == MARK).select("doc_id", "text_hash", "n_words")
    found = _occurrences(hits.where(F.col("gram") != MARK).distinct(), grams)
    found = materialise(found)
    by_doc = ["doc_id", "text_hash"]
    before = Window.partitionBy(*by_doc).orderBy("start", "stop").rowsBetween(
        Window.unboundedPreceding, -1
    )
    covered = (
        found.withColumn("done", F.coalesce(F.max("stop").over(before), F.lit(0)))
        .groupBy(*by_doc)
        .agg(
            F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "done")))
            .cast("long")
            .alias("n_hit")
        )
    )
    listed = (
        found.join(_small(window_items), "wid")
        .select(*by_doc, "item")
        .distinct()
        .groupBy(*by_doc)
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )

    out = _null_safe(_null_safe(marks, covered), listed)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "text_hash",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        ((n_hit > 0) & (parts * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, doc_id="doc_id", text="text", **options):
    """``docs`` without the contaminated rows; same columns."""
    found = contamination(docs, benchmark, doc_id, text, **options)
    bad = materialise(found.where("contaminated").select("doc_id", "text_hash").distinct())
    names = [fresh(n, docs) for n in ("hash_of_text", "bad_id", "bad_hash")]
    on = F.col(doc_id).eqNullSafe(F.col(names[1])) & (F.col(names[0]) == F.col(names[2]))
    bad = _small(bad.toDF(*names[1:]))
    rows = docs.withColumn(names[0], F.xxhash64(F.col(text)))
    return rows.join(bad, on, "left_anti").drop(names[0])


def _null_safe(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join by document, where a null id equals a null id; the keys of ``left`` stay."""
    right = right.withColumnsRenamed({"doc_id": "other_id", "text_hash": "other_hash"})
    on = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_hash") == F.col("other_hash"))
    return left.join(right.hint("merge"), on, how).drop("other_id", "other_hash")


def _hits(docs, grams, doc_id, text, lengths) -> DataFrame:
    """Where documents have shingles of the benchmark; a mark for each document besides."""
    df = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        word_list(F.col(text)).alias("w"),
    )
    n = F.size("w")

    def shingles(g: int) -> Column:
        every = F.transform(
            F.sequence(F.lit(0), n - g),
            lambda i: F.concat_ws(" ", *[F.get("w", i + j) for j in range(g)]),
        )
        return F.when(n >= g, every).otherwise(F.array().cast("array<string>"))

    spread = None
    wanted = grams.select("gram").distinct().unionByName(
        grams.sparkSession.range(1).select(F.lit(MARK).alias("gram"))
    )
    wanted = _small(wanted)
    head = F.array(F.lit(MARK))
    for k, g in enumerate(sorted(lengths, reverse=True) or [0]):
        entries = F.concat(head, shingles(g)) if g and k == 0 else head if k == 0 else shingles(g)
        rows = df.select(
            "doc_id",
            "text_hash",
            n.cast("long").alias("n_words"),
            F.posexplode(entries).alias("pos", "gram"),
        )
        rows = rows.withColumn("pos", F.col("pos") - (1 if k == 0 else 0)).join(wanted, "gram")
        spread = rows if spread is None else spread.unionByName(rows)
    return spread


def _occurrences(hits: DataFrame, grams: DataFrame) -> DataFrame:
    """Every place (start, stop) where a document contains a window."""
    counts = hits.groupBy("gram").agg(F.count("*").alias("seen"))
    ranked = grams.join(counts, "gram", "left")
    rarest = (
        ranked.groupBy("wid", "n", "g")
        .agg(
            F.min(F.coalesce("seen", F.lit(0))).alias("least"),
            F.min_by(
                F.struct("gram", "off"), F.struct(F.coalesce("seen", F.lit(0)), "gram", "off")
            ).alias("prefix"),
        )
        .where(F.col("least") > 0)
        .select("wid", "n", "g", "prefix.gram", "prefix.off")
    )
    start = F.col("pos") - F.col("off")
    candidates = (
        hits.join(_small(materialise(rarest)), "gram")
        .where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
        .select("doc_id", "text_hash", "wid", "n", "g", start.alias("start"))
    )
    # Shingles that together cover the window: every g-th, and the last.
    cover = grams.where((F.col("off") % F.col("g") == 0) | (F.col("off") == F.col("n") - F.col("g")))
    needed = cover.groupBy("wid").agg(F.collect_list(F.struct("off", "gram")).alias("cover"))
    c = candidates.join(_small(materialise(needed)), "wid").select(
        "doc_id",
        "text_hash",
        "wid",
        "start",
        (F.col("start") + F.col("n")).alias("stop"),
        F.size("cover").alias("needed"),
        F.inline("cover"),
    )
    there = hits.select(
        F.col("doc_id").alias("other_id"),
        F.col("text_hash").alias("other_hash"),
        "pos",
        F.col("gram").alias("other_gram"),
    )
    on = (
        F.col("doc_id").eqNullSafe(F.col("other_id"))
        & (F.col("text_hash") == F.col("other_hash"))
        & (F.col("start") + F.col("off") == F.col("pos"))
        & (F.col("gram") == F.col("other_gram"))
    )
    by = ["doc_id", "text_hash", "wid", "start", "stop", "needed"]
    return (
        c.join(there.hint("merge"), on, "left_semi")
        .groupBy(*by)
        .agg(F.count("*").alias("met"))
        .where(F.col("met") == F.col("needed"))
        .select("doc_id", "text_hash", "wid", "start", "stop")
    )
