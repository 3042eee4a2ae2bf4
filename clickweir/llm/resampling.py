"""Importance resampling towards a target text collection by hashed n-grams.

Features of a text are its runs of 1 to ``longest`` consecutive words; a feature
falls into the bucket of its CRC-32. A bucket's gain tells how much more often
the target has it than the corpus; a document's weight is the mean gain of its
features. Gumbel noise from a hash of the id makes a draw of the highest scores a
draw without replacement in proportion to the weights.

Prefix CRCs: a document is normalised to words parted by single spaces and
scanned once. ``E[i]``, the running CRC at the end of word i, comes from the one
before it; ``S[i]``, that at its start, is one more byte (the space). The CRC of
the words i to j, of ``n`` bytes, is ``E[j] ^ shift(S[i], n)``: appending n
bytes multiplies what came before by a fixed matrix over GF(2), so the common
prefix cancels. ``shift`` goes through the bits of n, with one table per power
of two, for all n-grams of a block at once. A text is taken in blocks of whole
words, so its length does not count.

Both passes over the corpus (bucket counts, then weights) read it once each; each
task folds its counts to one row per bucket before they are shuffled. The gains
are one number per bucket, so they may go along with the tasks. Ranks need no
total order in one task: scores are whole numbers in a range that the number of
buckets and the noise bound, rows are counted by score, and only the rows at or
above the last score drawn are ordered, each score by itself.

Defined results: a null text has no words, hence no features, weight 0 and no
rank; a null id scores as the id ``null`` and stands last among ties; repeated
rows each count, and rows of equal id and score take ranks next to each other;
with an empty target all counts of the target are 0; an empty corpus gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.common import copies_of, send_code
from clickweir.workspace import materialise

send_code(__name__)

BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 2, 20, 25, 7
_BLOCK = 1 << 18
_POLYNOMIAL = 0xEDB88320  # of CRC-32, bits reversed


def _letters() -> bytes:
    """A-Z become a-z; other ASCII characters but 0-9 and a-z become spaces."""
    table = bytearray(range(256))
    for c in range(128):
        kept = chr(c).lower()
        table[c] = ord(kept) if kept.isalnum() else 32
    return bytes(table)


_LETTERS = _letters()


def _times(matrix: list[int], value: int) -> int:
    """A 32 x 32 matrix over GF(2), given by its columns, times a vector."""
    out = 0
    for column in matrix:
        if value & 1:
            out ^= column
        value >>= 1
    return out


def _shift_tables(powers: int = 48) -> list[np.ndarray]:
    """Per k, four byte tables of the matrix that 2 ** k zero bytes apply to a CRC."""
    one_bit = [_POLYNOMIAL] + [1 << i for i in range(31)]
    matrix = one_bit
    for _ in range(3):  # one byte is eight bits
        matrix = [_times(matrix, c) for c in matrix]
    tables = []
    for _ in range(powers):
        table = np.zeros((4, 256), np.uint32)
        for byte in range(4):
            for bit in range(8):
                span = 1 << bit
                table[byte, span : 2 * span] = table[byte, :span] ^ np.uint32(
                    matrix[8 * byte + bit]
                )
        tables.append(table)
        matrix = [_times(matrix, c) for c in matrix]
    return tables


_SHIFTS = _shift_tables()
# After a byte b, a register r is (r >> 8) ^ step[(r ^ b) & 255]; step is a shift by one byte.
_SPACE_STEP = _SHIFTS[0][0]


def shift(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What the CRCs become once ``lengths`` more bytes follow, but for those bytes' own share."""
    out = crcs.copy()
    most = int(lengths.max(initial=0))
    for k in range(most.bit_length()):
        at = np.flatnonzero((lengths >> k) & 1)
        x, t = out[at], _SHIFTS[k]
        out[at] = (
            t[0][x & 255] ^ t[1][(x >> 8) & 255] ^ t[2][(x >> 16) & 255] ^ t[3][x >> 24]
        )
    return out


def _next_space(crcs: np.ndarray) -> np.ndarray:
    """The CRCs after one more space."""
    inside = ~crcs
    return ~((inside >> 8) ^ _SPACE_STEP[(inside ^ 32) & 255])


def _word_blocks(text: str, size: int) -> Iterator[list[bytes]]:
    """The words of a text in blocks of about ``size`` bytes, words whole."""
    line = text.encode().translate(_LETTERS)
    start = 0
    while start < len(line):
        end = line.find(b" ", start + size) if start + size < len(line) else -1
        end = len(line) if end < 0 else end
        words = line[start:end].split()
        if words:
            yield words
        start = end


def ngram_crcs(
    text: str | None, longest: int = LONGEST, block: int = _BLOCK
) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Per block of a text: its words, and the CRC-32s of the n-grams that end in it, by n."""
    before_e, before_s, before_at = (np.empty(0, t) for t in (np.uint32, np.uint32, np.int64))
    crc, offset, first = 0, 0, True
    for words in _word_blocks(text or "", block):
        ends = np.empty(len(words), np.uint32)
        for i, word in enumerate(words):
            crc = zlib.crc32(word if first else b" " + word, crc)
            first = False
            ends[i] = crc
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(sizes + 1) + offset - 1
        head = _next_space(before_e[-1:]) if offset else np.zeros(1, np.uint32)
        starts = np.concatenate((head, _next_space(ends[:-1])))
        s = np.concatenate((before_s, starts))
        e = np.concatenate((before_e, ends))
        begin_at = np.concatenate((before_at, stops - sizes))
        end_at = np.concatenate((before_at, stops))  # only the new ones are read
        old, found = len(before_s), []
        for n in range(1, longest + 1):
            j = np.arange(max(old, n - 1), len(s))
            i = j - (n - 1)
            found.append(e[j] ^ shift(s[i], end_at[j] - begin_at[i]))
        yield len(words), found
        offset = int(stops[-1]) + 1
        keep = min(len(s), max(longest - 1, 1))
        before_s, before_e, before_at = s[-keep:], e[-keep:], begin_at[-keep:]


def _buckets_of(found: list[np.ndarray], buckets: int) -> np.ndarray:
    return np.concatenate(found) % np.uint32(buckets)


_COUNTED = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])


def bucket_counts(
    texts: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST
) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                for _, found in ngram_crcs(value.as_py(), longest):
                    counts += np.bincount(_buckets_of(found, buckets), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[used])], schema=_COUNTED
        )

    per_task = texts.select(F.col(text)).mapInArrow(run, "bucket int, n bigint")
    return per_task.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Per bucket the floored thousandfold log ratio of its smoothed shares in target and corpus.

    ``corpus`` and ``target`` are counts of ``bucket_counts``; there are ``buckets`` numbers.
    """
    spark = corpus.sparkSession
    both = (
        spark.range(buckets)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(F.broadcast(corpus.withColumnRenamed("n", "s")), "bucket", "left")
        .join(F.broadcast(target.withColumnRenamed("n", "t")), "bucket", "left")
        .fillna(0, ["s", "t"])
    )

    def real(value: Column) -> Column:
        return value.cast("double")

    whole = Window.partitionBy()
    up = real(F.col("t") + 1) * real(F.sum("s").over(whole) + buckets)
    down = real(F.col("s") + 1) * real(F.sum("t").over(whole) + buckets)
    gain = F.floor(1000 * F.ln(up / down)).alias("gain")
    # As many rows as buckets, whatever the input.
    return [r["gain"] for r in both.select("bucket", gain).orderBy("bucket").collect()]


_WEIGHED = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight")])


def weights(
    docs: DataFrame,
    gain: list[int],
    doc_id: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row."""
    table = np.array(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros((batch.num_rows, 3), np.int64)
            for r, value in enumerate(batch.column(1)):
                total = 0
                for n_words, found in ngram_crcs(value.as_py(), longest):
                    hits = table[_buckets_of(found, len(table))]
                    rows[r, 0] += n_words
                    rows[r, 1] += len(hits)
                    total += int(hits.sum())
                rows[r, 2] = total // int(rows[r, 1]) if rows[r, 1] else 0
            columns = [batch.column(0), *[pa.array(rows[:, k].copy()) for k in range(3)]]
            yield pa.RecordBatch.from_arrays(columns, schema=_WEIGHED)

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    )


def with_scores(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """``score``: the weight with Gumbel noise that depends on the id and the seed only."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise)


def ranked(
    scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``rank`` of the drawn rows: the highest scores, ties by the smaller id; null for the others.

    ``scored`` is written down, since it is read several times.
    """
    long_enough = F.col("n_words") >= least_words
    by_score = scored.where(long_enough).groupBy("score").agg(F.count("*").alias("n"))
    # One row per score, and scores are whole numbers within fixed bounds.
    down = Window.orderBy(F.desc("score"))
    above = by_score.withColumns(
        {
            "above": F.sum("n").over(down) - F.col("n"),
            "drawn": F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100),
        }
    )
    above = materialise(above.where(F.col("above") < F.col("drawn")).drop("n"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    in_reach = scored.join(F.broadcast(above), "score", "left")
    reached = in_reach.where(long_enough & F.col("above").isNotNull())
    alike = reached.groupBy(*columns, "above", "drawn").agg(F.count("*").alias("n"))
    order = Window.partitionBy("score").orderBy(
        F.col("doc_id").asc_nulls_last(), "n_features", "n_words"
    )
    placed = alike.withColumn("rank", F.col("above") + F.sum("n").over(order) - F.col("n") + 1)
    each = copies_of(placed, "n", "copy_no").withColumn("rank", F.col("rank") + F.col("copy_no"))
    rank = F.when(F.col("rank") <= F.col("drawn"), F.col("rank"))
    none = F.lit(None).cast("long").alias("rank")
    rest = in_reach.where(~(long_enough & F.col("above").isNotNull()))
    return each.select(*columns, rank.alias("rank")).unionByName(rest.select(*columns, none))


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    *,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) per row of ``docs``."""
    gain = gains(
        bucket_counts(docs, text, buckets, longest),
        bucket_counts(target, target_text, buckets, longest),
        buckets,
    )
    scored = materialise(with_scores(weights(docs, gain, doc_id, text, longest), seed))
    return ranked(scored, percent, least_words)
