"""The folder all executors share, for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# The folder of the ``scratch`` block around the code that runs, per thread.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@cache
def _local_folder(application: str) -> str:
    """One folder per local session that has no setting; local tasks share the machine."""
    return tempfile.mkdtemp(prefix=f"{application}-")


def shared_base(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session may go without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path for ``purpose`` in the shared folder, or in the scratch folder around it."""
    base = _SCRATCH.get() or shared_base(spark)
    return f"{base}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: it does so when the driver collects.

    The steps' results are written tables, so nothing reads those files again.
    """
    spark._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Own the intermediates written inside the block: they are gone after it.

    For jobs that finish their work inside. A frame that is handed out lazily
    still reads its intermediates, so its caller opens the block.
    """
    folder = shared_dir(spark, "scratch")
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        remove(spark, folder)


def materialise(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written rows.

    ``options`` are those of Spark's Parquet writer.
    For a frame that several later steps read: it is computed once, and a lost
    executor costs a re-read and not a re-run.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "table")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` gives, written once; the intermediates it wrote are gone.

    For a small result of many steps: only the result stays in the shared folder.
    """
    path = shared_dir(spark, "table")
    with scratch(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
