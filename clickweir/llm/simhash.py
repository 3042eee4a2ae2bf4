"""Near-duplicate documents by SimHash and multi-index hashing.

A fingerprint has 64 bits: bit i is 1 if it is set in more than half of the
hashes of a text's word shingles. Fingerprints link at ``radius`` 2 or fewer
differing bits. Equal fingerprints are first collapsed to one row.

Multi-index hashing: a fingerprint is cut into two segments of 32 bits. If two
fingerprints differ in at most two bits, one segment differs in at most one, so
every fingerprint probes each segment's table with all values of the Hamming
ball of radius 1 (33 values), and the matches are verified over all 64 bits.

A segment value that more than ``hot`` fingerprints share would give pairs with
the square of their number. Fingerprints that probe such a value take an exact
other way: they are keyed by every value of the ball of radius 1 around the
whole fingerprint (65 keys). Two fingerprints that differ in at most two bits
share such a key, and all that share one differ in at most two bits, so linking
each to the least of its key loses no link and adds none.

Components are found on fingerprints and joined back to documents with hot
fingerprints split.

``keep_one_similar`` also links documents whose sets of 5-word shingles have an
exact Jaccard similarity of 0.8 or more, which few bits of a fingerprint do not
tell: MinHash bands give the candidates, as for ``lines``, a document's words
being one line.

Defined results: a null or blank text has fingerprint zero and is linked as any
other; a null id is kept, and is a component id only if the whole component
lacks ids; repeated rows get equal results; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm.common import ascii_lower, fresh, row_key, send_code, words
from clickweir.llm.components import connected_components
from clickweir.llm.lines import distinct_lines, line_components
from clickweir.operators.joins import salted_join
from clickweir.workspace import materialise, settle

send_code(__name__)

SEED = 42
NEAR_WORDS = 5  # words of a shingle where documents are compared by their shingle sets
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint, unsigned."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    spans = list(zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()))
    set_bits = np.zeros(64, np.int64)
    for k in range(0, len(spans), _BLOCK):
        block = spans[k : k + _BLOCK]
        hashes = np.fromiter(
            (xxh64_intdigest(line[a:b], SEED) for a, b in block), np.uint64, len(block)
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    over = set_bits * 2 > len(spans)
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, fp): ``fp`` as a signed long, ``key`` the same for equal id and text only."""
    out = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(
                (fingerprint(t.as_py()) for t in batch.column(2)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], schema=out
            )

    return docs.select(
        F.col(doc_id).cast("long"), row_key(F.col(doc_id), F.col(text)), F.col(text)
    ).mapInArrow(run, "doc_id bigint, key string, fp bigint")


def _segments(fp: Column) -> Column:
    return F.array(
        F.struct(F.lit(0).alias("seg"), F.shiftrightunsigned(fp, 32).alias("value")),
        F.struct(F.lit(1).alias("seg"), fp.bitwiseAND(F.lit((1 << 32) - 1)).alias("value")),
    )


def _ball(value: Column, bits: int) -> Column:
    """All values that differ from ``value`` in at most one of the lowest ``bits`` bits."""
    masks = [0] + [1 << i if i < 63 else -(1 << 63) for i in range(bits)]
    return F.transform(F.array(*map(F.lit, masks)), lambda m: value.bitwiseXOR(m))


def link_fingerprints(fps: DataFrame, radius: int = 2, hot: int = 64) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints of ``fps`` (fp) within ``radius`` bits."""
    if not 0 <= radius <= 2:
        raise ValueError("two segments with balls of radius 1 serve a radius of at most 2")
    index = fps.select("fp", F.inline(_segments(F.col("fp"))))
    probes = index.select("fp", "seg", F.explode(_ball(F.col("value"), 32)).alias("value"))
    crowded = materialise(
        index.groupBy("seg", "value").agg(F.count("*").alias("n")).where(F.col("n") > hot)
    ).drop("n")
    table = index.select(F.col("fp").alias("other"), "seg", "value")
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius
    matches = (
        probes.join(table.join(crowded, ["seg", "value"], "left_anti").hint("merge"), ["seg", "value"])
        .where(F.col("fp") < F.col("other"))
        .select(F.col("other").alias("u"), F.col("fp").alias("v"))
        .where(near)
    )
    in_crowd = probes.join(crowded, ["seg", "value"], "left_semi").select("fp").distinct()
    keyed = materialise(in_crowd).select("fp", F.explode(_ball(F.col("fp"), 64)).alias("near_fp"))
    hubs = keyed.groupBy("near_fp").agg(F.min("fp").alias("v"))
    stars = (
        keyed.join(hubs.hint("merge"), "near_fp")
        .where(F.col("fp") != F.col("v"))
        .select(F.col("fp").alias("u"), "v")
        .where(near)
    )
    return matches.unionByName(stars).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2, hot: int = 64
) -> DataFrame:
    """(doc_id, key, fp, component, component_id) for every row; ``component`` is a fingerprint."""
    return settle(docs.sparkSession, lambda: _grouped(docs, doc_id, text, radius, hot))


def _grouped(docs: DataFrame, doc_id: str, text: str, radius: int, hot: int) -> DataFrame:
    prints = materialise(fingerprints(docs, doc_id, text))
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    edges = materialise(link_fingerprints(distinct.select("fp"), radius, hot))
    parts = connected_components(edges).withColumnRenamed("node", "fp")
    parted = materialise(
        distinct.join(parts.hint("merge"), "fp", "left").withColumn(
            "component", F.coalesce("component", "fp")
        )
    )
    least = parted.groupBy("component").agg(F.min("first_id").alias("component_id"))
    found = parted.join(least.hint("merge"), "component").select("fp", "component", "component_id")
    return salted_join(prints, materialise(found), ["fp"], spread_by=["key"])


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the least id (then key) of every component; same columns."""
    return _least_of_each(docs, near_duplicates(docs, doc_id, text), doc_id, text)


def _least_of_each(docs: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    row = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    keepers = found.groupBy("component").agg(F.min_by("key", row).alias("key"))
    key = fresh("row_key", docs)
    kept = docs.withColumn(key, row_key(F.col(doc_id), F.col(text))).join(
        keepers.select(F.col("key").alias(key)).hint("merge"), key, "left_semi"
    )
    return kept.dropDuplicates([key]).drop(key)


def _similar_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, part) of every row: equal for rows linked by their 5-word shingles."""
    line = F.array_join(words(ascii_lower(F.col(text))), " ")
    rows = docs.select(row_key(F.col(doc_id), F.col(text)).alias("key"), line.alias("line"))
    named = rows.select("key", F.xxhash64("line").alias("id"), "line")
    texts = named.where(F.col("line") != "").select(
        "id",
        F.xxhash64(F.lit(1), "line").alias("check"),
        "line",
        F.lit(0).alias("text_hash"),
        F.lit(0).alias("line_no"),
        F.lit(0).alias("doc_id"),
    )
    with distinct_lines(texts) as lines:
        parts = materialise(line_components(lines, words=NEAR_WORDS))
        alone = lines.select("id").join(
            parts.select(F.col("node").alias("id")).hint("merge"), "id", "left_anti"
        )
        found = materialise(
            parts.select(F.col("node").alias("id"), F.col("component").alias("part")).unionByName(
                alone.select("id", F.col("id").alias("part"))
            )
        )
    return salted_join(named.select("key", "id").distinct(), found, ["id"], spread_by=["key"])


def _grouped_similar(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, key, component): components over both kinds of links."""
    prints = materialise(_grouped(docs, doc_id, text, 2, 64).select("doc_id", "key", "component"))
    parts = _similar_texts(docs, doc_id, text).select("key", "part")
    pairs = materialise(
        prints.select("key", "component").join(parts.hint("merge"), "key")
        .select("component", "part").distinct()
    )
    least = materialise(pairs.groupBy("part").agg(F.min("component").alias("v")))
    edges = salted_join(pairs, least, ["part"], spread_by=["component"])
    merged = connected_components(edges.select(F.col("component").alias("u"), "v"))
    merged = materialise(
        merged.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    )
    every = prints.select("component").distinct().join(merged.hint("merge"), "component", "left")
    every = materialise(every.withColumn("whole", F.coalesce("whole", "component")))
    placed = salted_join(prints, every, ["component"], spread_by=["key"])
    return placed.select("doc_id", "key", F.col("whole").alias("component"))


def keep_one_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``keep_one``, with documents of similar 5-word shingles linked as well."""
    found = settle(docs.sparkSession, lambda: _grouped_similar(docs, doc_id, text))
    return _least_of_each(docs, found, doc_id, text)
