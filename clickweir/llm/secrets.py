"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by its content (SHA-256 of the text).
The ledger is a Parquet table with one row per scanned (rule version, blob) and
all that was found in it, so a blob that many paths or versions share is
scanned once, and a later run scans only (rule version, blob) pairs that the
ledger does not have. ``findings_by_path`` joins the ledger back to all paths.

A rule is a kind, a pattern and the least length of one of its groups. Matches
are taken leftmost and without overlap; those that are too short are dropped
and not tried again. Their places come from splitting the text at the same
pattern: the pieces between the matches and the matches themselves add up to
the text. All of it is built-in functions; text is moved only to bring the
copies of a blob together, and each map task first merges its own copies.

Patterns have no greatest length: a long value ends where its own delimiters say.
Two runs that scan the same blob at once both append it; readers take one of the rows.

Defined results: a null text is an empty one; repeated rows and equal texts get
equal findings; null paths are kept; an empty table gives an empty result and
leaves the ledger as it is; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.operators.joins import fits_broadcast
from clickweir.workspace import materialise


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int
    at_least: int


# Patterns and their least lengths.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
RUN_START = "(?<![a-z0-9+.-])"
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1),
    Rule("hub_token", r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    # A scheme is taken from the start of its run, so that a long run is tried once.
    Rule(
        "login_url",
        rf"{RUN_START}[0-9+.-]*[a-z][a-z0-9+.-]*://[^\x09-\x0D\x20:/@]*:[^\x09-\x0D\x20:/@]+@",
        0,
        1,
    ),
)
RULES = BASE_RULES + MORE_RULES
RULE_VERSION = "3"

FINDING = "struct<start:bigint,rank:int,end:bigint,kind:string>"
LEDGER = f"rule_version string, blob string, findings array<{FINDING}>"


def read_ledger(spark: SparkSession, path: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """Blobs scanned under ``rule_version`` with their findings; empty if there is no ledger yet."""
    try:
        ledger = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        ledger = spark.createDataFrame([], LEDGER)
    return ledger.where(F.col("rule_version") == rule_version).drop("rule_version")


def address(versions: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and ``blob``, the address of the content."""
    return versions.select(*keep, F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("blob"))


def scan(blobs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """All findings of each row of ``blobs`` (blob, t), by place and then kind as listed."""

    def matched(rank: int, rule: Rule) -> Column:
        found = F.regexp_extract_all("t", F.lit(rule.pattern), F.lit(0))
        tested = F.regexp_extract_all("t", F.lit(rule.pattern), F.lit(rule.group))
        pieces = F.transform(F.split("t", rule.pattern, -1), F.length)
        entry = F.struct(
            F.lit(rank).alias("rank"),
            F.arrays_zip(
                pieces.alias("before"),
                F.transform(found, F.length).alias("length"),
                F.transform(tested, lambda x: F.length(x) >= rule.at_least).alias("good"),
            ).alias("matches"),
        )
        return F.when(F.col("t").rlike(rule.pattern), entry)

    # An entry without matches for each blob, so that clean blobs enter the ledger too.
    none = F.struct(
        F.lit(-1).alias("rank"),
        F.array().cast("array<struct<before:int,length:int,good:boolean>>").alias("matches"),
    )
    per_rule = blobs.select(
        "blob",
        F.inline(F.array_compact(F.array(none, *[matched(i, r) for i, r in enumerate(rules)]))),
    )
    rows = per_rule.select("blob", "rank", F.posexplode_outer("matches").alias("at", "m"))
    sofar = Window.partitionBy("blob", "rank").orderBy("at")
    end = F.sum(F.col("m.before") + F.coalesce("m.length", F.lit(0))).over(sofar)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    finding = F.struct(
        (F.col("end") - F.col("m.length")).cast("bigint").alias("start"),
        "rank",
        F.col("end").cast("bigint").alias("end"),
        F.get(kinds, F.col("rank")).alias("kind"),
    )
    return (
        rows.withColumn("end", end)
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list(F.when(F.col("m.good"), finding))).alias("findings"))
    )


def scan_unseen(
    versions: DataFrame,
    ledger_path: str,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    rule_version: str = RULE_VERSION,
    broadcast_rows: int = 100_000,
) -> None:
    """Scan the blobs of ``versions`` that the ledger lacks, and append them to it."""
    spark = versions.sparkSession
    seen = read_ledger(spark, ledger_path, rule_version).select("blob")
    unseen = materialise(address(versions, text).distinct().join(seen, "blob", "left_anti"))
    rows = versions.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.select(F.sha2("t", 256).alias("blob"), "t")
    if fits_broadcast(unseen, broadcast_rows):  # few are new: the others never leave the scan
        rows = rows.join(F.broadcast(unseen), "blob", "left_semi")
    # Equal rows merge in the map tasks, however many copies a text has.
    blobs = rows.groupBy("blob").agg(F.first("t").alias("t"))
    blobs = blobs.join(unseen.hint("merge"), "blob", "left_semi")
    scan(blobs, rules).select(F.lit(rule_version).alias("rule_version"), "blob", "findings").write.mode(
        "append"
    ).parquet(ledger_path)


def findings_by_path(
    versions: DataFrame,
    ledger_path: str,
    keep: Sequence[str],
    text: str = "text",
    rule_version: str = RULE_VERSION,
) -> DataFrame:
    """``keep`` columns, ``blob`` and ``findings`` for every row of ``versions``.

    Only blobs with findings are joined; a blob that many paths share is split
    over tasks by adaptive execution, since its rows need not stay together.
    """
    paths = address(versions, text, keep)
    found = read_ledger(versions.sparkSession, ledger_path, rule_version)
    # Stored, so that the join below reads both sides alike and can split a hot blob.
    found = materialise(found.where(F.size("findings") > 0).dropDuplicates(["blob"]))
    nothing = F.array().cast(f"array<{FINDING}>")
    return paths.join(found, "blob", "left").withColumn(
        "findings", F.coalesce("findings", nothing)
    )


def span_text(findings: Column) -> Column:
    """``kind:start:end`` of every finding, comma-joined."""
    return F.array_join(
        F.transform(
            findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
        ),
        ",",
    )
