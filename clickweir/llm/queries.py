"""One registered query per operator: it applies the operator to its whole table.

``CHECKS`` maps a name to the query and to the SQL it must agree with, or None
where SQL cannot say it; those are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm import (
    contamination,
    html,
    lines,
    mixing,
    oracles,
    pii,
    quality,
    resampling,
    secrets,
    sharding,
    simhash,
    tokens,
    trie,
    warc,
)
from clickweir.llm.common import table
from clickweir.workspace import shared_dir

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def op1_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(table(spark, d, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op2_secrets(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    ledger = shared_dir(spark, "ledger")
    secrets.scan_unseen(docs, ledger)
    found = secrets.findings_by_path(docs, ledger, ["doc_id"])
    base = F.filter("findings", lambda x: x["rank"] < len(secrets.BASE_RULES))

    def of(kind: str):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("findings")).alias("spans"),
    )


def op3_warc(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    index = warc.write_archives(table(spark, d, "pages"), folder)
    return warc.read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents")).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op5_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.line_report(table(spark, d, "documents"), native=True)


def op6_html(spark: SparkSession, d: str) -> DataFrame:
    return html.extract(table(spark, d, "pages"))


def op7_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.copies(table(spark, d, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op8_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.personal_data(table(spark, d, "documents"))


def op9_tokens(spark: SparkSession, d: str) -> DataFrame:
    return tokens.count_tokens(table(spark, d, "documents"), VOCABULARY)


def op10_contamination(spark: SparkSession, d: str) -> DataFrame:
    found = contamination.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.assign_shards(table(spark, d, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_trie(spark: SparkSession, d: str) -> DataFrame:
    return trie.prefix_trie(table(spark, d, "conversations")).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )


def op13_resampling(spark: SparkSession, d: str) -> DataFrame:
    return resampling.resample(table(spark, d, "documents"), table(spark, d, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )


CHECKS = {
    "op1_quality": (op1_quality, oracles.QUALITY),
    "op2_secrets": (op2_secrets, oracles.SECRETS),
    "op3_warc": (op3_warc, oracles.WARC),
    "op4_simhash": (op4_simhash, None),
    "op5_lines": (op5_lines, None),
    "op6_html": (op6_html, None),
    "op7_mixing": (op7_mixing, oracles.MIXING),
    "op8_pii": (op8_pii, None),
    "op9_tokens": (op9_tokens, None),
    "op10_contamination": (op10_contamination, oracles.CONTAMINATION),
    "op11_sharding": (op11_sharding, oracles.SHARDING),
    "op12_trie": (op12_trie, oracles.TRIE),
    "op13_resampling": (op13_resampling, oracles.RESAMPLING),
}
