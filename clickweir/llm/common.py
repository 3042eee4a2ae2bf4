"""What the text operators share: words, lower case, row keys, tables."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    text = F.coalesce(text, F.lit(""))
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def row_key(doc_id: Column, text: Column) -> Column:
    """A key by which rows of equal id and text, and only those, are the same."""
    return F.md5(
        F.concat(
            F.coalesce(doc_id.cast("string"), F.lit("null")),
            F.lit(":"),
            F.coalesce(F.md5(text), F.lit("null")),
        )
    )


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no frame has a column of that name."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def send_code(module: str) -> None:
    """Send this module's functions along with tasks, so workers need not have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def copies_of(df: DataFrame, count: str, number: str, block: int = 1024) -> DataFrame:
    """Each row as often as ``count`` says, numbered from 0 in ``number`` instead of ``count``.

    A count above ``block`` is first cut into blocks that are dealt out over the
    tasks, so no task has to make all copies of one row.
    """
    size = F.lit(block).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.col(count) - 1, size)
    blocks = df.where(F.col(count) > 0).withColumn(number, F.explode(starts))
    few = blocks.where(F.col(count) <= size)
    many = blocks.where(F.col(count) > size)
    many = many.repartition(*many.columns)
    last = F.least(F.col(number) + size, F.col(count)) - 1
    return (
        few.unionByName(many)
        .withColumn(number, F.explode(F.sequence(F.col(number), last)))
        .drop(count)
    )
