"""Connected components of a stored edge list, by alternating star contractions.

Large star: every node links its larger neighbours to its smallest one. Small
star: every node links its smaller neighbours, and itself, to the smallest. The
two are repeated until nothing changes; every node is then linked to the least
node of its component. Minima pre-aggregate in the map tasks, so a node with
very many edges is no hot group, and its joined rows may be split over tasks.
Each round is written to the shared folder, so lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.workspace import materialise


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (
        both.join(least.hint("merge"), "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least.hint("merge"), "u").where(F.col("v") != F.col("m"))
    return (
        small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is its least node.

    Loops and repeated or reversed edges do no harm; rows with a null are
    dropped; no edges give no rows.
    """
    edges = edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = materialise(edges.distinct())

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = state(edges)
    while now[0]:
        edges = materialise(_stars(edges))
        before, now = now, state(edges)
        if before == now:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
