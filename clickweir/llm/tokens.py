"""Token counts by unigram scores over a trie of pre-tokens.

A text is split at ASCII white space into pre-tokens; each is segmented into
pieces of a vocabulary so that the sum of the pieces' log probabilities is
largest (fewest pieces where sums are equal). A character that no piece covers
falls back to its UTF-8 bytes, one token each. The best score of a prefix does
not depend on what follows, so it is computed once for every node of the trie
of the distinct pre-tokens of a block of texts. The trie is walked depth first,
which is the sorted order of the pre-tokens: only the scores along the current
path are in memory. The number of tokens at each terminal node is stored, and
texts add up the counts of their pre-tokens.

The vocabulary file gives an order of pieces and no probabilities; the log
probability of the piece of rank r is taken as -ln(r + 1) - ln(ln(n)).
Vocabularies are bounded (tens of thousands of short pieces) and travel as one
broadcast variable. Rows are independent, so nothing is shuffled.

Defined results: null and empty texts have no tokens; repeated rows get equal
counts; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.common import send_code

send_code(__name__)

# Where a word begins, as the vocabulary spells it.
BEGIN = "▁"
BLOCK_CHARS = 8_000_000


def load_pieces(path: str) -> dict[str, float]:
    """Log probability by piece of a sentence piece vocabulary, without special and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    shift = math.log(math.log(max(len(ids), 3)))
    return {model.id_to_piece(i): -math.log(r + 1) - shift for r, i in enumerate(ids)}


def byte_score(pieces: dict[str, float]) -> float:
    """Log probability of a byte: well below any piece."""
    return min(pieces.values(), default=0.0) - 10.0


def token_counts(words: set[str], pieces: dict[str, float]) -> dict[str, int]:
    """Tokens of each distinct pre-token, sharing the scores of common prefixes."""
    longest = max(map(len, pieces), default=1)
    per_byte = byte_score(pieces)
    score, tokens = [0.0], [0]  # of the prefixes on the current path
    before, counts = "", {}
    for word in sorted(words):
        spelled = BEGIN + word
        shared, most = 0, min(len(spelled), len(before))
        while shared < most and spelled[shared] == before[shared]:
            shared += 1
        del score[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared + 1, len(spelled) + 1):
            n_bytes = len(spelled[end - 1].encode("utf-8", "surrogatepass"))
            best, fewest = score[end - 1] + n_bytes * per_byte, tokens[end - 1] + n_bytes
            for begin in range(max(0, end - longest), end):
                p = pieces.get(spelled[begin:end])
                if p is not None:
                    s, t = score[begin] + p, tokens[begin] + 1
                    if s > best or (s == best and t < fewest):
                        best, fewest = s, t
            score.append(best)
            tokens.append(fewest)
        counts[word] = tokens[-1]
        before = spelled
    return counts


def split_words(text: str | None) -> list[str]:
    """Pre-tokens between ASCII white space."""
    if not text:
        return []
    return [w.decode() for w in text.encode().split()]


def _blocks(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    block, size = [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        text = text.as_py()
        block.append((doc_id, Counter(split_words(text))))
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def count_tokens(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pre-tokens, distinct pre-tokens and tokens of every row."""
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))
    out = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "n_words", "n_distinct_words", "n_tokens")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch):
                counts = token_counts(set(chain.from_iterable(c for _, c in block)), pieces.value)
                rows = [
                    (i, c.total(), len(c), sum(counts[w] * n for w, n in c.items()))
                    for i, c in block
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in zip(*rows)], schema=out
                )

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_distinct_words bigint, n_tokens bigint"
    )
