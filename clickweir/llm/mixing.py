"""Mixing sources to target weights by systematic sampling.

Sources in code point order, null last, weigh 5, 2, 1 and so on again. Together
they get a share of all words; no target exceeds twice the size of its source,
and what is cut off is dealt out again by weight until no target is above.
Within a source every document has the same expected copies (target / size of
the source). Documents stand in a fixed order, that of a hash; their expected
copies are summed up, one random offset of the source is added, and a document
is emitted once for each whole number the sum crosses. The offset is that one of
``draws`` seeded random offsets whose mix has the words nearest to the target.

The prefix sum is distributed: rows are numbered within cells (source, hash
bucket), cells are counted, and the counts are summed up over the buckets of a
source. So no task needs all rows of a source: windows run over one cell, over
the 4096 buckets of a source, and over the list of sources.

Defined results: a null text has size 0; documents of size 0 can be emitted and
add no words; a null source is one source, last; repeated rows each count and
may get different numbers of copies, the same ones in every run; an empty table
gives an empty result; other columns are only carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.common import row_key, words
from clickweir.operators.joins import lookup_join
from clickweir.workspace import materialise

WEIGHTS = (5, 2, 1)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, limit: float = 2.0
) -> DataFrame:
    """``target`` and ``rate`` (expected copies) for rows of (src, source, source_size).

    In the order of limit by weight, a source is cut to its limit while that is
    below the level (words by weight) that is left for it and those after it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn(
        "weight",
        F.get(
            F.array(*map(F.lit, weights)),
            F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))),
        ),
    ).withColumn("most", F.col("source_size") * F.lit(limit))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(share)
    left = total - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    leveled = weighed.withColumns(
        {"level": left / F.sum("weight").over(after), "place": F.row_number().over(order)}
    ).withColumn("cut", F.col("most") / F.col("weight") < F.col("level"))
    rest = F.min_by(
        F.when(~F.col("cut"), F.col("level")), F.when(~F.col("cut"), F.col("place"))
    ).over(Window.partitionBy(F.lit(1)))
    target = F.when(F.col("cut"), F.col("most")).otherwise(F.col("weight") * rest)
    return leveled.select(
        "src",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size"))
        .otherwise(F.lit(0.0))
        .alias("rate"),
    )


def _offsets(draws: int, seed: int):
    """``draws`` numbers in [0, 1) that depend on the source and the seed only."""

    def drawn(i):
        named = F.concat("src", F.lit(f"/{seed}/"), i.cast("string"))
        return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / float(2**32)

    return F.transform(F.sequence(F.lit(1), F.lit(draws)), drawn)


def _emitted(offset):
    """Whole numbers that the sum crosses at a row."""
    sofar = [F.floor(offset + F.col("rate") * (F.col("rank") - k)) for k in (0, 1)]
    return sofar[0] - sofar[1]


def copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: Sequence[str] = (),
    seed: int = 7,
    draws: int = 64,
    **options,
) -> DataFrame:
    """Each row's size, its source's size and target, and how often the mix takes it.

    ``keep`` names columns that come along in ``kept_columns``.
    """
    key = row_key(F.col(doc_id), F.col(text))
    placed = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("kept_columns")
        if keep
        else F.lit(True).alias("kept_columns"),
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("src"),
        key.alias("key"),
        F.substring(key, 1, 3).alias("bucket"),
        F.size(words(F.col(text))).cast("long").alias("size"),
    )
    if not keep:
        placed = materialise(placed)
    cell = ["src", "bucket"]
    cells = materialise(
        placed.groupBy("source", *cell).agg(
            F.count("*").alias("rows"), F.sum("size").alias("words")
        )
    )
    up_to = Window.partitionBy("src").orderBy("bucket")
    firsts = cells.select(*cell, (F.sum("rows").over(up_to) - F.col("rows")).alias("first"))
    sizes = cells.groupBy("source", "src").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, **options).withColumn("offsets", _offsets(draws, seed))
    targets = materialise(targets)
    place = F.row_number().over(Window.partitionBy(*cell).orderBy("key"))
    ranked = (
        placed.withColumn("place", place)
        .join(firsts, cell)
        .select(
            "kept_columns", "doc_id", "src", "size", (F.col("first") + F.col("place")).alias("rank")
        )
    )
    ranked = materialise(ranked)
    tried = lookup_join(ranked.select("src", "size", "rank"), targets, ["src"])
    taken = tried.groupBy("src").agg(
        *[
            F.sum(F.col("size") * _emitted(F.get("offsets", F.lit(k)))).alias(f"taken{k}")
            for k in range(draws)
        ]
    )
    misses = F.array(
        *[
            F.struct(F.abs(F.col(f"taken{k}") - F.col("target")), F.get("offsets", F.lit(k)))
            for k in range(draws)
        ]
    )
    best = taken.join(targets, "src").select(
        "src", "source_size", "target", "rate", F.array_min(misses)["col2"].alias("offset")
    )
    return lookup_join(ranked, materialise(best), ["src"]).select(
        "kept_columns",
        "doc_id",
        "size",
        "source_size",
        "target",
        _emitted(F.col("offset")).alias("copies"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, numbered by ``copy_no`` from 1."""
    chosen = copies(docs, keep=docs.columns, **options).where(F.col("copies") > 0)
    return chosen.select(
        "kept_columns.*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no")
    )
