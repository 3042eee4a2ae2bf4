"""Sharding, the conversation trie and importance resampling, against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickweir.llm import resampling, sharding, trie
from clickweir.llm.common import copies_of

# --- sharding


def brute_shards(rows, shards):
    """The documented order and cuts, in one list."""
    found = [(i, (t or "").encode()) for i, t in rows]
    total = sum(len(t) + 16 for _, t in found)
    unit = max(1, total // (shards * sharding.UNIT))

    def key(value):
        return int(hashlib.md5(value).hexdigest()[:15], 16)

    groups = Counter()
    for _, t in found:
        groups[t] += len(t) + 16
    pieces = []
    for (i, t), n in Counter(found).items():
        size, step = len(t) + 16, max(1, unit // (len(t) + 16))
        for start in range(0, n, step):
            name = f"{'null' if i is None else i}:{start}".encode()
            second = key(name) if groups[t] > unit else -1
            order = (key(t), second, i is not None, i or 0, size, start)
            pieces.append((order, i, t, min(step, n - start)))
    pieces.sort()
    units, sofar = defaultdict(int), 0
    for order, _, t, m in pieces:
        units[order[:2]] += m * (len(t) + 16)
    middle = {}
    for name, size in sorted(units.items()):
        middle[name] = 2 * sofar + size
        sofar += size
    slots, out = Counter(), []
    for order, i, t, m in pieces:
        shard = middle[order[:2]] * shards // (2 * total)
        for _ in range(m):
            out.append((i, len(t) + 16, zlib.crc32(t), shard, slots[shard]))
            slots[shard] += 1
    return Counter(out)


COLUMNS = ["doc_id", "size", "text_crc32", "shard", "slot"]


def test_shards_of_the_documents(docs, rows, clashing, empty):
    want = brute_shards([(r.doc_id, r.text) for r in rows], 40)
    for frame in (docs, clashing.repartition(3)):
        got = sharding.assign_shards(frame).select(*COLUMNS).collect()
        assert Counter(map(tuple, got)) == want
    assert sharding.assign_shards(empty).count() == 0


@pytest.mark.parametrize("ranges", [1, 7, 300])
def test_hot_texts_and_rows_are_divided(spark, ranges):
    draw = random.Random(4)
    rows = [(i, f"text {draw.randrange(10**9)} " * draw.randrange(1, 9)) for i in range(900)]
    rows += [(5000 + i, "the same text in very many documents") for i in range(700)]
    rows += [(7, "one row, repeated")] * 500 + [(None, None)] * 60 + [(8, "")] * 40
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.assign_shards(frame, shards=10, ranges=ranges)
    listed = got.collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in listed) == brute_shards(rows, 10)
    sizes = Counter()
    for r in listed:
        sizes[r.shard] += r.size
    mean = sum(sizes.values()) / 10
    assert len(sizes) == 10 and all(abs(s - mean) < 0.05 * mean for s in sizes.values())
    of_text = defaultdict(set)
    for r in listed:
        of_text[r.text_crc32].add(r.shard)
    spread = {c for c, s in of_text.items() if len(s) > 1}
    hot = {zlib.crc32(t.encode()) for t in (rows[900][1], "one row, repeated", "")}
    assert spread <= hot and len(spread) >= 2  # all other texts are in one shard


def test_no_range_is_overfull(spark):
    keyed = spark.range(4000).select(
        (F.col("id") % 50).alias("text_key"),
        F.col("id").alias("id_key"),
        F.lit(0).alias("piece"),
        F.when(F.col("id") % 50 == 3, 40).otherwise(1).cast("double").alias("weight"),
    )
    total = keyed.agg(F.sum("weight")).first()[0]
    weighed = keyed.withColumn("weight", F.col("weight") / total)
    placed = sharding._ranged(weighed, 100)
    worst = placed.groupBy("range").agg(F.sum("weight").alias("w"), F.count("*").alias("n"))
    assert worst.where("w > 0.02 and n > 1").isEmpty()
    ends = placed.groupBy("range").agg(
        F.min(F.struct("text_key", "id_key")).alias("a"), F.max(F.struct("text_key", "id_key")).alias("b")
    )
    listed = sorted((r.range, tuple(r.a), tuple(r.b)) for r in ends.collect())
    assert all(x[2] < y[1] for x, y in zip(listed, listed[1:]))


def test_written_shards(spark, clashing, tmp_path):
    path = str(tmp_path / "shards")
    placed = sharding.write_shards(clashing, path, shards=5)
    back = spark.read.parquet(path)
    assert Counter(map(tuple, back.select(*clashing.columns).collect())) == Counter(
        map(tuple, clashing.collect())
    )
    crc = F.crc32(F.coalesce("text", F.lit("")))
    assert Counter(map(tuple, back.select("shard", "slot", "doc_id", crc).collect())) == Counter(
        map(tuple, placed.select("shard", "slot", "doc_id", "text_crc32").collect())
    )


def test_copies(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 5), ("d", 10)], "x string, n long")
    got = copies_of(df, "n", "k", block=4).groupBy("x").agg(F.sort_array(F.collect_list("k")).alias("k"))
    assert {r.x: r.k for r in got.collect()} == {"b": [0], "c": list(range(5)), "d": list(range(10))}


# --- conversations

TRIE_COLUMNS = (
    "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
)


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        turns = own.get(c - c % 20, [])[:h] + own[c][h:]
        ends[tuple(turns)].append(c)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, convs in members.items():
        tokens = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(convs) - 1) * tokens
    return Counter(
        (
            min(convs),
            len(p),
            min(members[p[:-1]]) if p else None,
            len(convs),
            children[p],
            leaves[p],
            saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, convs in members.items()
    )


def trie_of(frame):
    return Counter(map(tuple, trie.prefix_trie(frame).select(*TRIE_COLUMNS).collect()))


def test_trie_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 3)  # long conversations are cut
    draw = random.Random(9)
    rows = []
    for c in [*range(0, 61), 199, 10_020, 10_033]:
        for t in range(draw.choice([0, 1, 2, 3, 5, 9])):
            text = draw.choice(["hi there", "a b  c\nd", "", None, "ü x"])
            rows.append((c, draw.choice([t, t, t, 3, None]), draw.choice(["u", "a", None]), text))
    rows += [(500, 0, "u", "hi there")] * 4 + [(None, 0, "u", "no conversation")]
    rows += [(c, 0, "u", "one frequent conversation") for c in range(20_000, 20_060)]
    rows += [(30_000, t, "u", f"turn {t % 7}") for t in range(40)]
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame(rows, schema).repartition(3)
    want = brute_trie(rows)
    assert trie_of(frame) == want
    extra = frame.select("*", *[F.lit("clash").alias(n) for n in ("node", "parent", "place", "h0")])
    assert trie_of(extra) == want
    assert trie_of(frame.limit(0)) == Counter()


def test_contraction_of_random_trees(spark):
    draw = random.Random(2)
    parent = {0: None}
    for v in range(1, 150):  # bushy, then a chain, then a star
        parent[v] = draw.randrange(v)
    for v in range(150, 260):
        parent[v] = v - 1
    for v in range(260, 330):
        parent[v] = 259
    parent[400], parent[401] = None, 400
    value = {v: draw.randrange(100) for v in parent}
    want = dict(value)
    for v in sorted(parent, reverse=True):
        if parent[v] is not None:
            want[parent[v]] += want[v]
    nodes = spark.createDataFrame(
        [(b"%d" % v, None if p is None else b"%d" % p, value[v], 1) for v, p in parent.items()],
        "node binary, parent binary, x long, y long",
    )
    got = {int(r.node): r.x for r in trie.subtree_sums(nodes, ["x", "y"]).collect()}
    assert got == want


# --- resampling

FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def feature_words(text):
    return FEATURE_WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features(text, longest=2):
    w = feature_words(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("block", [1, 9, 1 << 18])
def test_crcs_from_prefixes(block):
    draw = random.Random(1)
    texts = ["".join(draw.choice("aBZ z9,ü😀\n\x00") for _ in range(draw.randrange(300))) for _ in range(40)]
    for text in [*texts, "", None, "x" * 5000 + " y " + "z" * 70_000]:
        for longest in (1, 2, 4):
            parts = list(resampling.ngram_crcs(text, longest, block))
            got = Counter(int(x) for _, found in parts for crcs in found for x in crcs)
            assert got == Counter(zlib.crc32(f.encode()) for f in features(text, longest))
            assert sum(n for n, _ in parts) == len(feature_words(text))


def brute_resampled(rows, target):
    of = [Counter(zlib.crc32(f.encode()) % 10_000 for f in features(t)) for _, t in rows]
    s, t = sum(of, Counter()), Counter()
    for text in target:
        t.update(zlib.crc32(f.encode()) % 10_000 for f in features(text))
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(
            1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))
        )

    scored = []
    for (i, text), counts in zip(rows, of):
        n = sum(counts.values())
        weight = sum(gain(b) * k for b, k in counts.items()) // n if n else 0
        name = f"7:{'null' if i is None else i}".encode()
        h = int(hashlib.sha256(name).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, n, weight, weight + noise, len(feature_words(text)) >= 20))
    drawn = sorted((x for x in scored if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    out = [(*x[:4], k + 1) for k, x in enumerate(drawn[: 25 * len(drawn) // 100])]
    out += [(*x[:4], None) for x in drawn[25 * len(drawn) // 100 :]]
    return Counter(out + [(*x[:4], None) for x in scored if not x[4]])


RESAMPLED = ["doc_id", "n_features", "weight", "score", "rank"]


def test_resampling(spark, docs, rows, clashing, empty):
    bench = spark.createDataFrame(
        [(r.doc_id, r.text) for r in rows[:30]] + [(None, None)], "item_id long, text string"
    )
    given = [(r.doc_id, r.text) for r in rows]
    want = brute_resampled(given, [r.text for r in rows[:30]])
    for frame in (docs, clashing):
        got = resampling.resample(frame, bench).select(*RESAMPLED).collect()
        assert Counter(map(tuple, got)) == want
    assert resampling.resample(empty, bench).count() == 0
    got = resampling.resample(docs, bench.limit(0)).select(*RESAMPLED).collect()
    assert Counter(map(tuple, got)) == brute_resampled(given, [])


def test_ranks_of_very_many_equal_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text)] * 1500 + [(i, f"{text} {i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = resampling.resample(frame, frame.limit(0)).select(*RESAMPLED).collect()
    assert Counter(map(tuple, got)) == brute_resampled(rows, [])
