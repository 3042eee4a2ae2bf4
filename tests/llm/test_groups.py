"""Operators on groups of documents, against plain Python over all pairs."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import brute
import pytest
from pyspark.sql import functions as F

from clickweir.llm import contamination, lines, mixing, simhash
from clickweir.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def test_components_of_random_graphs(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(300)]
    edges += [(None, 3), (7, 7), (8, 9), (9, 8)]
    frame = spark.createDataFrame(edges, "u long, v long")
    kept = [(u, v) for u, v in edges if u is not None and u != v]
    want = brute.components({x for e in kept for x in e}, kept)
    assert {tuple(r) for r in connected_components(frame).collect()} == set(want.items())
    assert connected_components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [0, 3, 64])
def test_fingerprint_links(spark, hot):
    draw = random.Random(5)
    base = [draw.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base[:12]:  # dense groups, and chains of two bits each
        for _ in range(25):
            fps.add(b ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)))
        x = b
        for _ in range(4):
            x ^= (1 << draw.randrange(64)) | (1 << draw.randrange(64))
            fps.add(x)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    links = [(a, b) for a, b in combinations(fps, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    want = brute.components({x for e in links for x in e}, links)
    got = connected_components(simhash.link_fingerprints(frame, hot=hot))
    assert {tuple(r) for r in got.collect()} == set(want.items())


def test_near_duplicates(docs, rows, empty):
    fps = [(r.doc_id, brute.fingerprint(r.text)) for r in rows]
    distinct = sorted({fp for _, fp in fps})
    links = [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= 2]
    part = brute.components(distinct, links)
    least = defaultdict(list)
    for i, fp in fps:
        if i is not None:
            least[part[fp]].append(i)
    want = Counter((i, fp, min(least[part[fp]], default=None)) for i, fp in fps)
    got = simhash.near_duplicates(docs).select("doc_id", "fp", "component_id").collect()
    assert Counter((r[0], r[1] % (1 << 64), r[2]) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each_group_stays(clashing):
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    found = simhash.near_duplicates(clashing)
    assert kept.count() == found.select("component").distinct().count()
    ids = {r[0] for r in kept.select("doc_id").collect()}
    least = {r[0] for r in found.groupBy("component").agg(F.min("doc_id")).select("min(doc_id)").collect()}
    assert ids == least


def test_similar_documents(spark):
    draw = random.Random(23)
    pairs = []

    def grams(words):
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}

    for n, changes in [(200, 1), (100, 1), (200, 3), (1000, 15), (60, 1), (2000, 30)] * 6:
        a = [f"w{draw.randrange(5000)}" for _ in range(n)]
        b = list(a)
        for k in range(changes):  # spread evenly
            b[(2 * k + 1) * n // (2 * changes)] = "other"
        similarity = len(grams(a) & grams(b)) / len(grams(a) | grams(b))
        pairs.append((" ".join(a), "  " + " \n".join(b).upper(), similarity))
    # below 0.8 both stay
    far = [f"w{draw.randrange(5000)}" for _ in range(100)]
    pairs.append((" ".join(far), " ".join("other" if k % 20 == 10 else w for k, w in enumerate(far)), 0))
    rows = [(2 * i + k, pair[k]) for i, pair in enumerate(pairs) for k in (0, 1)]
    rows += [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "ONE"), (None, "one")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in simhash.keep_one_similar(frame).collect())
    firsts = [2 * i for i in range(len(pairs))]
    also = [2 * i + 1 for i, p in enumerate(pairs) if p[2] < 0.8]
    assert kept == sorted([*firsts, *also, 900, 903])
    assert len(also) == 1
    assert simhash.keep_one_similar(frame.limit(0)).count() == 0


def _items(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    extra = [(9001, "same id"), (9001, "same id"), (9002, "One, TWO three!"), (9003, None), (9004, "--"),
             (9005, "two"), (None, "one two")]
    return given.unionByName(spark.createDataFrame(extra, "item_id long, text string"))


def test_contamination(spark, docs, rows, empty):
    items = _items(spark)
    given = [tuple(r) for r in items.collect()]
    want = Counter()
    for r, (n, hit, ids) in zip(rows, brute.contamination([(r.doc_id, r.text) for r in rows], given)):
        want[(r.doc_id, n, hit, len(ids), ",".join(ids), hit > 0 and 20 * hit >= n)] += 1
    got = contamination.contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", F.array_join("items", ","), "contaminated"
    )
    assert Counter(map(tuple, got.collect())) == want
    assert contamination.contamination(empty, items).count() == 0
    none = contamination.contamination(docs, items.limit(0))
    assert none.where("contaminated or n_hit > 0 or n_items > 0").count() == 0
    assert none.count() == len(rows)


def test_clean_documents_stay(spark, clashing, rows):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = brute.contamination(
        [(r.doc_id, r.text) for r in rows], [(r.item_id, r.text) for r in items.collect()]
    )
    clean = Counter(
        r.doc_id for r, (n, hit, _) in zip(rows, found) if not (hit and 20 * hit >= n)
    )
    kept = contamination.keep_clean(clashing, items)
    assert kept.columns == clashing.columns
    assert Counter(r[0] for r in kept.select("doc_id").collect()) == clean


def _near_lines():
    draw = random.Random(11)

    def word():
        return "".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(2, 9)))

    texts = []
    originals = [" ".join(word() for _ in range(draw.randrange(3, 60))) for _ in range(30)]
    for i in range(60):
        picked = [draw.choice(originals) for _ in range(4)]
        changed = []
        for line in picked:
            w = line.split()
            for _ in range(draw.randrange(0, 4)):
                w[draw.randrange(len(w))] = word()
            changed.append(" ".join(w))
        texts.append((i, "\n".join([*changed, "", "  short  ", picked[0]])))
    return texts


@pytest.mark.parametrize("native", [False, True])
def test_similar_lines(spark, native):
    texts = _near_lines() + [(None, "short\nonly here"), (70, None), (71, ""), (71, ""), (72, " \t\n ")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    cut = {
        (i, k): x.strip()
        for i, t in texts
        if t is not None
        for k, x in enumerate(t.split("\n"))
        if x.strip()
    }
    part = brute.line_groups(set(cut.values()))
    keeper = {}
    for place in sorted(cut, key=lambda p: (p[0] is None, p[0] or 0, p[1])):
        keeper.setdefault(part[cut[place]], place)
    want = {p for p in cut if keeper[part[cut[p]]] != p}
    got = {(r.doc_id, r.line_no) for r in lines.repeated_lines(frame, native=native).collect()}
    assert not got - want  # every removed line is similar, by links, to one that stays
    assert len(got) >= 0.98 * len(want)  # and banding finds nearly all of them
    exact = {p for p in want if any(cut[q] == cut[p] for q in cut if q != p)}
    repeats = {p for p in exact if cut[p] in [cut[q] for q in cut if q != p and q not in want]}
    assert repeats <= got
    kept = {
        (r.doc_id, r.text) for r in lines.keep_lines(frame, native=native).select("doc_id", "text").collect()
    }
    for i, t in texts:
        if t is None:
            assert (i, None) in kept
        else:
            left = "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in got)
            assert (i, left) in kept


@pytest.mark.parametrize("native", [False, True])
def test_similar_lines_with_other_word_starts(spark, native):
    draw = random.Random(17)

    def word(n):
        return "".join(draw.choice("abcdefghijklmnop") for _ in range(n))

    pairs = []
    for _ in range(10):  # many spaces, but nearly all of the text without any
        body = "".join(chr(draw.randrange(0x4E00, 0x9F00)) for _ in range(2000))
        pairs.append([" ".join(word(3) for _ in range(28)) + " " + body for _ in range(2)])
    for _ in range(10):  # a third of the words differ in their first letter
        long = [word(60) for _ in range(30)]
        pairs.append([" ".join(long), " ".join("z" + w[1:] if k % 3 == 0 else w for k, w in enumerate(long))])
    for a, b in pairs:
        x, y = lines.shingle_set(a), lines.shingle_set(b)
        assert len(x & y) >= 0.8 * len(x | y)
    rows = [(2 * i + k, line) for i, pair in enumerate(pairs) for k, line in enumerate(pair)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r.doc_id for r in lines.repeated_lines(frame, native=native).collect()}
    assert gone == {2 * i + 1 for i in range(len(pairs))}


def test_line_report(docs, rows, empty, clashing):
    report = lines.line_report(docs)
    assert report.count() == len(rows)
    for r in report.collect():
        gone = [x for x in r.removed_lines.split(",") if x]
        assert r.n_kept == r.n_lines - len(gone)
    assert lines.line_report(empty).count() == 0
    kept = lines.keep_lines(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == len(rows)
    wrong = kept.where("text is not null and n_chars <> char_length(text)").join(
        docs.select("doc_id", "n_chars"), ["doc_id", "n_chars"], "left_anti"
    )
    assert wrong.count() == 0


def test_mix(docs, rows, empty, clashing):
    got = mixing.copies(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(brute.words(r.text))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    target |= {s: weight[s] * level for s in free}
    wanted = sorted((sizes[s], round(target[s], 6)) for s in names for r in rows if r.source == s)
    assert sorted((r.source_size, round(r.target, 6)) for r in got) == wanted
    taken = Counter()
    for r in got:
        assert 0 <= r["copies"] <= 2
        taken[r.source_size] += r["copies"] * r["size"]
    longest = max(len(brute.words(r.text)) for r in rows if len(brute.words(r.text)) < 20_000)
    for s in names:
        if sizes[s] not in (0, max(sizes.values())):
            assert abs(taken[sizes[s]] - target[s]) <= max(longest, 0.05 * target[s])
    again = mixing.copies(docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    mixed = mixing.mix(clashing)
    assert mixed.columns == [*clashing.columns, "copy_no"]
    assert mixed.count() == sum(r["copies"] for r in got)
    assert mixing.copies(empty).count() == 0


def _pairs_of_second_pass(spark, texts, words=None):
    """The pairs that ``_with_all`` gives for lines that are all apart."""
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    none = spark.createDataFrame([], "node long, component long")
    prefixes = lines._rare_shingles(rows.select("id"), rows, words)
    found = lines._with_all(lines._with_component(prefixes, none)).collect()
    return {(r.u, r.v) for r in found}


@pytest.mark.parametrize("words", [None, 5])
def test_no_similar_pair_is_left_out(spark, words):
    draw = random.Random(8)
    texts = []
    for _ in range(12):
        base = [f"w{draw.randrange(300)}" for _ in range(draw.choice([3, 9, 40, 90]))]
        for _ in range(8):
            changed = list(base)
            for _ in range(draw.randrange(3)):
                changed[draw.randrange(len(changed))] = f"x{draw.randrange(50)}"
            texts.append(" ".join(changed))
    texts = sorted(set(texts))
    sets = [lines.shingle_set(t, words) for t in texts]
    similar = {
        (v, u)
        for u, v in combinations(range(len(texts)), 2)
        if 5 * len(sets[u] & sets[v]) >= 4 * len(sets[u] | sets[v])
    }
    assert len(similar) > 5
    assert similar <= _pairs_of_second_pass(spark, texts, words)


def test_dissimilar_lines_of_one_band_are_not_paired(spark):
    draw = random.Random(8)
    frame = "the terms of this page apply to all of its readers and to "
    texts = [frame + "".join(draw.choice("abcdefghij ") for _ in range(40)) for _ in range(2000)]
    assert len(_pairs_of_second_pass(spark, texts)) < 2000



def test_shingles_of_the_same_lines_are_paired_once(spark):
    draw = random.Random(5)
    body = " ".join("".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(50))
    texts = [f"{body} {i:03d}" for i in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    prefixes = lines._rare_shingles(rows.select("id"), rows)
    whole = [r for r in prefixes.groupBy("h").count().collect() if r["count"] == len(texts)]
    assert len(whole) == 1  # all shingles of the body, which stand in the same lines
    assert _pairs_of_second_pass(spark, texts) == {
        (v, u) for u, v in combinations(range(len(texts)), 2)
    }


def test_near_copies_are_mostly_linked_before_all_are_paired(spark, monkeypatch):
    draw = random.Random(6)

    def word():
        return "".join(draw.choice("abcdefghij") for _ in range(5))

    base = [word() for _ in range(60)]
    texts = []
    for _ in range(300):
        changed = list(base)
        for k in draw.sample(range(60), draw.randrange(1, 4)):
            changed[k] = word()
        texts.append(" ".join(changed))
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    made, pairs = [], lines._pairs

    def counted(joined):
        made.append(joined.where(lines._may_be_similar()).count())
        return pairs(joined)

    monkeypatch.setattr(lines, "_pairs", counted)
    got = {r.node: r.component for r in lines.line_components(rows).collect()}
    sets = [lines.shingle_set(t) for t in texts]
    links = [
        (u, v)
        for u, v in combinations(range(len(texts)), 2)
        if 5 * len(sets[u] & sets[v]) >= 4 * len(sets[u] | sets[v])
    ]
    assert len(links) > 5000
    assert all(got[u] == got[v] for u, v in links)
    assert made[1] < len(links) / 2


def _stages(frame, name):
    """How often ``name`` stands in the plan that runs, one that is reused not counted."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return sum(name in line and "Reused" not in line for line in plan.splitlines())


@pytest.mark.parametrize("native", [False, True])
def test_shingles_of_the_second_pass_are_made_and_moved_once(spark, tmp_path, native):
    texts = [f"line {i % 7} of the table has words of its own {i}" for i in range(50)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    rows.write.parquet(str(tmp_path / "lines"))
    table = spark.read.parquet(str(tmp_path / "lines"))
    prefixes = lines._rare_shingles(table.select("id"), table, native=native)
    if not native:
        assert _stages(prefixes, "MapInArrow") == 1
    assert _stages(prefixes, "Exchange hashpartitioning(h#") == 1
    assert _stages(prefixes, "collect_list(struct") == 0


def test_pairs_of_lines_leave_no_copies_of_lines(spark, tmp_path, monkeypatch):
    import os

    from clickweir import workspace

    monkeypatch.setattr(workspace, "shared_base", lambda spark: str(tmp_path))
    draw = random.Random(3)
    base = ["".join(draw.choice("abcdefghij ") for _ in range(200)) for _ in range(20)]
    texts = [x[:k] + "#" + x[k:] for x in base for k in (20, 60, 100, 180)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    parts = lines.line_components(rows)
    assert parts.count() == len(texts)
    left = [
        os.path.join(d, f) for d, _, files in os.walk(tmp_path) for f in files if f.startswith("part-")
    ]
    columns = {c for f in left for c in spark.read.parquet(f).columns}
    assert not columns & {"line", "line_u", "line_v", "component_a", "row"}


TEXTS_TO_CUT = [
    "abc",
    "abcdefgh",
    "aaaaaaaaaaaaaaaaaaaa",
    "nul \x00 and tab \t are ASCII too",
    "d\u00e9j\u00e0 vu, d\u00e9j\u00e0 vu, d\u00e9j\u00e0 vu",
    "\u4e2d\u6587",
    "\u4e2d\u6587 and \U0001f600 in one longer line \U0001f600",
    "\u00e9" * 30,
]


def test_packed_shingles_are_the_shingles():
    for a in TEXTS_TO_CUT:
        packed, made = lines._packed(a), lines.shingle_set(a)
        assert (packed is None) == (len(a) < lines.SHINGLE or max(a) > "\xff")
        for b in TEXTS_TO_CUT:
            other = lines._packed(b)
            if packed is not None and other is not None:
                assert len(packed) == len(made)
                assert lines._common(packed, other) == len(made & lines.shingle_set(b))


def test_hashes_in_built_in_functions_are_those_of_all_shingles(spark):
    frame = spark.createDataFrame([(x,) for x in TEXTS_TO_CUT], "line string")
    got = {r.line: r.hs for r in frame.select("line", lines._hashes(F.col("line")).alias("hs")).collect()}
    for line in TEXTS_TO_CUT:
        cut = spark.createDataFrame([(x,) for x in lines.shingle_set(line)], "s string")
        want = [r.h for r in cut.select(F.xxhash64("s").alias("h")).collect()]
        assert sorted(got[line]) == sorted(want)


def test_only_wanted_lines_are_cut_in_the_second_pass(spark, tmp_path):
    texts = [f"line {i % 7} of the table has words of its own {i}" for i in range(50)]
    spark.createDataFrame(list(enumerate(texts)), "id long, line string").write.parquet(
        str(tmp_path / "lines")
    )
    table = spark.read.parquet(str(tmp_path / "lines"))
    prefixes = lines._rare_shingles(table.select("id").where("id < 5"), table, native=True)
    plan = prefixes._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "xxhash64" in x]


def test_lines_of_small_open_bands_are_compared_within_their_band(spark):
    rows = [(b, n, i, c) for b, n in ((1, 4), (2, lines.FEW + 1)) for i, c in ((1, 1), (2, 1), (3, 3), (4, 4))]
    opened = spark.createDataFrame(rows, "band long, n long, id long, component long")
    got = {(r.u, r.v) for r in lines._within(opened.where("band = 1")).collect()}
    assert got == {(3, 1), (3, 2), (4, 1), (4, 2), (4, 3)}
    assert lines._within(opened.where("band = 2")).count() == 0


def test_lines_query_runs_no_python(spark, monkeypatch):
    from clickweir.llm import queries

    def refused(*_):
        raise AssertionError("the query runs Python on the executors")

    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", refused)
    assert queries.op5_lines(spark, SF).count() > 0


def test_lines_and_bands_are_made_in_slices(spark, monkeypatch):
    draw = random.Random(5)
    base = ["".join(draw.choice("abcdefghij ") for _ in range(120)).strip() for _ in range(12)]
    texts = ["\n".join(x[:k] + "#" + x[k:] for x in base[i % 7 :]) for i, k in enumerate((9, 40, 9, 77))]
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[1]), (None, texts[1]), (9, None), (8, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    where = ("doc_id", "text_hash", "line_no")

    def repeated():
        return sorted(map(str, lines.repeated_lines(docs, native=True).select(*where).collect()))

    whole = repeated()
    assert whole
    moved = []
    monkeypatch.setattr(lines, "SLICE_TEXT", 1)
    monkeypatch.setattr(lines, "BAND_ROWS", 1)
    monkeypatch.setattr(lines, "BAND_SLICES", 3)
    monkeypatch.setattr(lines, "release_shuffles", moved.append)
    assert repeated() == whole
    # After each slice of the lines and of the bands, and more often after these.
    assert len(moved) > lines.SLICES + lines.BAND_SLICES
    with lines.distinct_lines(lines._occurrences(docs, "doc_id", "text"), 3) as table:
        got = {r.line: r.copies for r in table.collect()}
    expected = Counter(x.strip() for _, t in rows for x in (t or "").split("\n") if x.strip())
    assert got == expected
