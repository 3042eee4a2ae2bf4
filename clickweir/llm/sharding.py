"""Sharding by sampled splitters: shards of near equal bytes.

Records have a key: first a hash of the text, so that equal texts stand together,
then, in groups of equal texts that are too large for one place, a hash of the id.

1. Rows of equal id and text fold to one record with a count; only sizes, hashes
   and counts go on. A count is cut into pieces of ``UNIT`` of a shard's share.
2. Groups of equal texts above that share are split by id (at most ``shards /
   UNIT`` groups can be, so their list is broadcast); all others stay together.
3. A sample of keys is drawn, each record in proportion to its weight (half by
   bytes, half by rows): a number of points that a hash of its key rounds up or
   down. Quantiles of the sample are the splitters of the ranges.
4. Every record finds its range by binary search in the list of splitters. Ranges are
   measured over all rows; a range above twice its share that has several keys
   is subdivided at splitters from a denser sample of its own, until none is left.
5. Sizes are summed up over the ranges, and within each range over its records in
   the order of keys. A shard takes whole ranges, and the range in which it ends
   is divided at the unit (group or piece) whose middle crosses its share. So
   ``shards`` differ by about a unit, or a single document if that is larger.
   Places (``slot``) are numbered likewise.

No task sees more than one range, and the number of ranges grows with the rows.
The result does not depend on the sample, the partitions or the run.

Defined results: a null text is the empty one (16 bytes); null ids come first
among equal texts; repeated rows each count and get places of their own; an
empty table gives an empty result; more shards than records leave some empty;
other columns are only carried along (``write_shards``) or never read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.common import copies_of, fresh
from clickweir.workspace import materialise, settle

SHARDS, OVERHEAD = 40, 16
UNIT = 50  # the largest group that stays together is a shard's share of bytes over this
RANGES, OVERSAMPLE, RANGE_ROWS = 16, 8, 1_000_000


def _hash(value: Column) -> Column:
    """60 bits of a hash that is the same everywhere."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def _rounding(*key: Column) -> Column:
    """A number in [0, 1) that depends on the key only."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / float(1 << 30)


def records(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", overhead: int = OVERHEAD
) -> DataFrame:
    """(text_key, doc_id, size, text_crc32, copies): one row per id and text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.select(
            _hash(whole).alias("text_key"),
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(whole) + overhead).cast("long").alias("size"),
            F.crc32(whole).alias("text_crc32"),
        )
        .groupBy("text_key", "doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
    )


def _keyed(rows: DataFrame, unit: int, groups: int) -> DataFrame:
    """Records with their second key, in pieces of at most ``unit`` bytes (or one copy)."""
    bytes_of = F.sum(F.col("size") * F.col("copies"))
    sizes = rows.groupBy("text_key").agg(bytes_of.alias("group_bytes"))
    # At most ``groups`` groups can be above the unit, since together they have all bytes.
    large = sizes.where(F.col("group_bytes") > unit).select("text_key", F.lit(True).alias("large"))
    placed = rows.join(F.broadcast(large), "text_key", "left")
    step = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(unit) / F.col("size")))
    starts = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, step)
    pieces = placed.withColumns({"step": step, "piece": F.explode(starts)})
    named = F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("piece")
    )
    return pieces.select(
        "text_key",
        F.when(F.col("large"), _hash(named)).otherwise(F.lit(-1).cast("long")).alias("id_key"),
        "doc_id",
        "size",
        "text_crc32",
        "piece",
        F.least(F.col("step"), F.col("copies") - F.col("piece")).alias("copies"),
    )


def _weighed(keyed: DataFrame, total: int, rows: int) -> DataFrame:
    """``weight``: a record's bytes, and its rows as if each had the mean bytes."""
    mean = total / rows
    return keyed.withColumn(
        "weight", F.col("copies") * (F.col("size") + F.lit(mean)) / F.lit(2.0 * total)
    )


def _key() -> Column:
    return F.struct("text_key", "id_key")


def sampled_splitters(weighed: DataFrame, ranges: int | Column, within: Column) -> DataFrame:
    """(text_key, id_key): keys at the quantiles of a weighted sample.

    ``ranges`` is how many ranges a whole weight of 1 would be cut into; ``within``
    names the part a row is in, which is cut on its own.
    """
    points = F.floor(
        F.col("weight") * ranges * OVERSAMPLE
        + _rounding(F.col("text_key"), F.col("id_key"), F.col("piece"))
    )
    sample = weighed.select("text_key", "id_key", within.alias("part"), points.alias("points"))
    drawn = sample.where(F.col("points") > 0).groupBy("part", "text_key", "id_key").agg(
        F.sum("points").alias("points")
    )
    # As many rows as points, whose number follows from ``ranges`` and not from the rows.
    up_to = Window.partitionBy("part").orderBy("text_key", "id_key")
    sofar = F.sum("points").over(up_to)
    quantile = F.floor(sofar / OVERSAMPLE) > F.floor((sofar - F.col("points")) / OVERSAMPLE)
    return drawn.withColumn("at", quantile).where("at").select("text_key", "id_key")


def in_range(rows: DataFrame, splitters: DataFrame) -> DataFrame:
    """``range``: how many splitters a key reaches, by binary search."""
    # A few thousand keys: their number follows from the number of ranges.
    keys = [tuple(r) for r in splitters.orderBy("text_key", "id_key").collect()]
    count = len(keys)
    if count == 0:
        return rows.withColumn("range", F.lit(0))
    listed = json.dumps([{"text_key": a, "id_key": b} for a, b in keys])
    bounds = F.from_json(F.lit(listed), "array<struct<text_key: bigint, id_key: bigint>>")
    steps = [1 << k for k in reversed(range(count.bit_length()))]
    held = F.struct(_key().alias("key"), bounds.alias("bounds"))

    def search(x: Column) -> Column:
        return F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda low, step: F.when(
                (low + step <= count) & (F.get(x["bounds"], low + step - 1) <= x["key"]), low + step
            ).otherwise(low),
        )

    return rows.withColumn("range", F.get(F.transform(F.array(held), search), F.lit(0)))


def _ranged(weighed: DataFrame, ranges: int) -> DataFrame:
    """Every row with its range; no range of several keys is above twice its share."""
    share = 1.0 / ranges
    splitters = materialise(sampled_splitters(weighed, ranges, F.lit(0)).distinct())
    while True:
        placed = in_range(weighed, splitters)
        measured = placed.groupBy("range").agg(
            F.sum("weight").alias("range_weight"),
            F.min(_key()).alias("low"),
            F.max(_key()).alias("high"),
        )
        overfull = materialise(
            measured.where(
                (F.col("range_weight") > 2 * share) & (F.col("low") < F.col("high"))
            ).select("range", "high", F.ceil(2 * F.col("range_weight") / share).alias("cuts"))
        )
        if overfull.isEmpty():
            return placed
        # A range has one row here, and there are as many ranges as splitters.
        inside = placed.join(F.broadcast(overfull), "range")
        denser = inside.withColumn("weight", F.col("weight") / share)
        finer = sampled_splitters(denser, F.lit(2) * F.col("cuts"), F.col("range"))
        # The greatest key divides a range in any case, so every round gets on.
        ends = overfull.select("high.*")
        splitters = materialise(splitters.unionByName(finer).unionByName(ends).distinct())


def assign_shards(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    overhead: int = OVERHEAD,
    ranges: int | None = None,
) -> DataFrame:
    """(doc_id, text_key, size, text_crc32, shard, slot, copy_no), one row per row of ``docs``.

    ``copy_no`` counts the rows of equal id and text from 0.
    """
    return settle(
        docs.sparkSession, lambda: _assigned(docs, doc_id, text, shards, overhead, ranges)
    )


def _assigned(docs, doc_id, text, shards, overhead, ranges) -> DataFrame:
    rows = materialise(records(docs, doc_id, text, overhead))
    total, n = rows.agg(
        F.coalesce(F.sum(F.col("size") * F.col("copies")), F.lit(0)),
        F.coalesce(F.sum("copies"), F.lit(0)),
    ).first()
    unit = max(1, total // (shards * UNIT))
    keyed = materialise(_keyed(rows, unit, shards * UNIT))
    ranges = ranges or max(shards * RANGES, n // RANGE_ROWS)
    placed = _ranged(_weighed(keyed, max(total, 1), max(n, 1)), ranges) if n else keyed.withColumn(
        "range", F.lit(0)
    )
    piece_bytes = F.col("size") * F.col("copies")
    placed = materialise(placed.withColumn("bytes", piece_bytes).drop("weight"))

    # One row per range.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("range").agg(F.sum("bytes").alias("b"), F.sum("copies").alias("n"))
    offsets = offsets.select(
        "range",
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
    )
    unit_of = Window.partitionBy("range", "text_key", "id_key")
    units = Window.partitionBy("range").orderBy("text_key", "id_key")
    order = units.orderBy("text_key", "id_key", "doc_id", "size", "text_crc32", "piece")
    summed = placed.join(F.broadcast(offsets), "range").select(
        "text_key",
        "doc_id",
        "size",
        "text_crc32",
        "piece",
        "copies",
        (F.col("bytes_before") + F.sum("bytes").over(units)).alias("end"),
        F.sum("bytes").over(unit_of).alias("unit_bytes"),
        (
            F.col("rows_before")
            + F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0))
            - F.col("copies")
        ).alias("place"),
    )
    # Twice the middle of the unit, in whole numbers.
    middle = 2 * F.col("end") - F.col("unit_bytes")
    shard = F.expr(f"(twice_middle * {shards}) div {2 * max(total, 1)}")
    sharded = materialise(
        summed.withColumn("twice_middle", middle)
        .withColumn("shard", shard.cast("int"))
        .drop("end", "unit_bytes", "twice_middle")
    )
    firsts = sharded.groupBy("shard").agg(F.min("place").alias("first"))
    slots = sharded.join(F.broadcast(firsts), "shard").withColumn(
        "slot", F.col("place") - F.col("first")
    )
    each = copies_of(slots.drop("place", "first"), "copies", "copy_no")
    return each.select(
        "doc_id",
        "text_key",
        "size",
        "text_crc32",
        "shard",
        (F.col("slot") + F.col("copy_no")).alias("slot"),
        (F.col("piece") + F.col("copy_no")).alias("copy_no"),
    )


def write_shards(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    file_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Write the rows of ``docs`` below ``path`` as ``shard=<n>`` folders in the order of slots.

    Returns what ``assign_shards`` does. Rows
    of equal id and text get the places of their kind in any order.
    """
    placed = assign_shards(docs, doc_id, text, shards)
    left = materialise(
        docs.select(
            F.struct(*docs.columns).alias("row"),
            _hash(F.coalesce(F.col(text), F.lit(""))).alias("text_key"),
            F.col(doc_id).alias("doc_id"),
            F.spark_partition_id().alias("part"),
        )
    )
    # Repeated rows are numbered per written partition, so very many copies are no one group.
    record = ["text_key", "doc_id"]
    earlier = Window.partitionBy(*record).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = left.groupBy(*record, "part").agg(F.count("*").alias("n"))
    counts = counts.withColumn("n", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    place = F.row_number().over(Window.partitionBy(*record, "part").orderBy(F.lit(0))) - 1
    left, counts, right = left.withColumn("place", place).alias("l"), counts.alias("c"), placed.alias("r")

    def same(a: str, b: str) -> Column:
        ids = F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
        return (F.col(f"{a}.text_key") == F.col(f"{b}.text_key")) & ids

    numbered = left.join(
        counts.hint("merge"), same("l", "c") & (F.col("l.part") == F.col("c.part"))
    ).select("l.row", "l.text_key", "l.doc_id", (F.col("place") + F.col("n")).alias("copy_no"))
    shard, slot = fresh("shard", docs), fresh("slot", docs)
    joined = (
        numbered.alias("l")
        .join(right.hint("merge"), same("l", "r") & (F.col("l.copy_no") == F.col("r.copy_no")))
        .select("row.*", F.col("r.shard").alias(shard), F.col("r.slot").alias(slot))
    )
    files = max(shards, placed.count() // file_rows)
    (
        joined.repartitionByRange(files, shard, slot)
        .sortWithinPartitions(shard, slot)
        .write.partitionBy(shard)
        .parquet(path)
    )
    return placed
