"""Operators that give one row per document or page, against plain Python."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import brute
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickweir.llm import pii, quality, queries, secrets, tokens, warc
from clickweir.workspace import materialise, shared_dir


def bag(frame):
    return Counter(map(tuple, frame.collect()))


def test_quality_counts(docs, rows):
    got = quality.judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
    )
    assert bag(got) == Counter((r.doc_id, *brute.quality(r.text)) for r in rows)


def test_quality_distance_and_verdict(spark):
    common = quality.COMMON["en"]

    def text(i: int) -> str:
        words = [common[(i + j) % 20] if j % 3 else f"w{i}x{j}." for j in range(300)]
        return " ".join(words)

    good = [(i, text(i), "en") for i in range(30)]
    junk = " ".join(w + "%%$$##" for w in text(50).split())
    odd = " ".join(f"z{j}q." for j in range(300))
    short = "the " + " ".join(f"%{j}%" for j in range(55))
    rows = [*good, (97, short, "en"), (98, odd, "en"), (99, junk, "en"), (96, text(51), None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality.judge(frame).collect()}
    counted = quality.base_counts(frame).collect()
    for lang in ("en", "other"):
        group = [r for r in counted if r.lang == lang]
        for bins, name, guard in (("chars", "chars_distance", 300), ("common", "common_distance", 150)):
            size = "n_chars" if bins == "chars" else "n_words"
            given = [r[bins] for r in group if not r.base_failed and r[bins]]
            for r in group:
                distance = found[r.doc_id][name]
                if r[size] < guard or not r[bins]:
                    assert distance is None
                else:
                    want = brute.js_distance(r[bins], [sum(x) for x in zip(*given)])
                    assert abs(distance - want) < 1e-9
    assert all(found[i].kept for i in (*range(30), 96))
    assert not found[99].kept and not found[99].base_failed  # symbols
    assert not found[98].kept and not found[98].base_failed  # no common words
    assert found[97].chars_distance is None and found[97].kept  # too short to be judged


def test_quality_keeps_columns_and_handles_empty(clashing, empty):
    kept = quality.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert 0 < kept.count() < clashing.count()
    assert quality.judge(empty).count() == 0


def test_secrets(docs, rows, spark):
    ledger = shared_dir(spark, "ledger")
    secrets.scan_unseen(docs, ledger)
    found = secrets.findings_by_path(docs, ledger, ["doc_id"])
    base = F.filter("findings", lambda x: x["rank"] < 3)

    def of(kind):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind))

    got = found.select(
        "doc_id", of("assign"), of("access"), of("hex"), F.sha2(secrets.span_text(base), 256)
    )
    assert bag(got) == Counter((r.doc_id, *brute.secrets(r.text)) for r in rows)


def test_ledger_scans_only_what_is_new(spark):
    def frame(*texts):
        return spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(texts)], "path string, text string")

    ledger = shared_dir(spark, "ledger")
    key = "token = 'abcdefgh'"
    secrets.scan_unseen(frame(key, "clean", key), ledger)
    assert secrets.read_ledger(spark, ledger).count() == 2
    secrets.scan_unseen(frame("clean", key, "newer " + key, None), ledger)
    assert secrets.read_ledger(spark, ledger).count() == 4
    # Another rule version scans everything again, beside the first.
    secrets.scan_unseen(frame(key), ledger, rule_version="next")
    assert secrets.read_ledger(spark, ledger, "next").count() == 1
    assert secrets.read_ledger(spark, ledger).count() == 4
    found = secrets.findings_by_path(frame(key, "clean", key), ledger, ["path"])
    spans = {r.path: r.s for r in found.select("path", secrets.span_text(F.col("findings")).alias("s")).collect()}
    assert spans == {"p0": "assign:0:17", "p1": "", "p2": "assign:0:17"}


def test_more_secret_kinds(spark):
    text = (
        "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1B2" * 10 + " xoxb-123456789012 "
        "ftp://me:pass1@host eyJhbGciOiJI.eyJzdWIiOiIx.abcDEF_1"
    )
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ledger = shared_dir(spark, "ledger")
    secrets.scan_unseen(frame, ledger)
    found = secrets.findings_by_path(frame, ledger, ["doc_id"]).first().findings
    kinds = {f.kind: text[f.start : f.end] for f in found}
    assert set(kinds) == {"private_key", "hub_token", "chat_token", "login_url", "web_token"}
    assert kinds["login_url"] == "ftp://me:pass1@"


def test_secrets_of_any_length(spark):
    word = "p4" * 100
    texts = {
        1: f"https://{word}:{word}@host",
        2: f"{'x+' * 40}y://u:{word}@host -redis://:{word}@host",
        3: f"-----BEGIN {'VERY ' * 30}PRIVATE KEY-----",
        4: "ab.1-" * 200_000,
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    ledger = shared_dir(spark, "ledger")
    secrets.scan_unseen(frame, ledger)
    # Two runs at once: the same blobs twice in the ledger.
    ledger_rows = secrets.read_ledger(spark, ledger)
    again = materialise(ledger_rows.select(F.lit(secrets.RULE_VERSION).alias("rule_version"), "blob", "findings"))
    again.write.mode("append").parquet(ledger)
    rows = secrets.findings_by_path(frame, ledger, ["doc_id"]).collect()
    taken = {r.doc_id: [texts[r.doc_id][f.start : f.end] for f in r.findings] for r in rows}
    assert len(rows) == 4
    assert taken[1] == [f"https://{word}:{word}@"]
    assert taken[2] == [f"{'x+' * 40}y://u:{word}@", f"-redis://:{word}@"]
    assert taken[3] == [texts[3]]
    assert taken[4] == []


def test_secrets_clashing_names(clashing):
    ledger = shared_dir(clashing.sparkSession, "ledger")
    secrets.scan_unseen(clashing, ledger)
    found = secrets.findings_by_path(clashing, ledger, ["doc_id"])
    assert found.count() == clashing.count()


def test_secrets_empty(spark, empty):
    ledger = shared_dir(spark, "ledger")
    secrets.scan_unseen(empty, ledger)
    assert secrets.findings_by_path(empty, ledger, ["doc_id"]).count() == 0


def test_personal_data(docs, rows, empty):
    got = pii.personal_data(docs).drop("spans")
    assert bag(got) == Counter((r.doc_id, *brute.personal(r.text)) for r in rows)
    assert pii.personal_data(empty).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1029.@+-() %_\nü😀5", max_size=60))
def test_personal_data_any_text(text):
    spans = pii.find_spans(text, pii._anchors())
    named = [f"{k}:{a}:{b}" for k in pii.BASE_KINDS for a, b in spans[k]]
    assert brute.personal(text)[-1] == brute.sha256(",".join(named))


def test_more_personal_kinds():
    text = "IBAN: DE89 3704 0044 0532 0130 00, SSN 078-05-1120, http://ann:pw@host.org, user @ann_b"
    spans = pii.find_spans(text, pii._anchors())
    taken = {k: [text[a:b] for a, b in v] for k, v in spans.items()}
    assert taken["iban"] == ["DE89 3704 0044 0532 0130 00"]
    assert taken["ssn"] == ["078-05-1120"]
    assert taken["login"] == ["ann:pw@host.org"]
    assert taken["handle"] == ["ann_b"]
    wrong = pii.find_spans("IBAN DE88 3704 0044 0532 0130 00", pii._anchors())
    assert wrong["iban"] == []


def test_personal_values_of_any_length():
    word, gap = "p4" * 100, " :#=\t" * 4
    text = f"IBAN{gap}DE89 3704 0044 0532 0130 00, SSN{gap}078-05-1120, http://{word}:{word}@host.org, user @{word}"
    spans = pii.find_spans(text, pii._anchors())
    taken = {k: [text[a:b] for a, b in v] for k, v in spans.items()}
    assert taken["iban"] == ["DE89 3704 0044 0532 0130 00"]
    assert taken["ssn"] == ["078-05-1120"]
    assert taken["login"] == [f"{word}:{word}@host.org"]
    assert taken["handle"] == [word]


def test_personal_data_clashing_names(clashing):
    assert pii.personal_data(clashing).count() == clashing.count()


def test_token_counts(docs, rows, empty):
    pieces = tokens.load_pieces(queries.VOCABULARY)
    per_byte = tokens.byte_score(pieces)
    known = {}

    def count(word):
        if word not in known:
            if len(word) > 1000:  # quadratic in plain Python
                known[word] = tokens.token_counts({word}, pieces)[word]
            else:
                known[word] = brute.fewest_tokens(tokens.BEGIN + word, pieces, per_byte)
        return known[word]

    want = Counter()
    for r in rows:
        w = brute.words(r.text)
        want[(r.doc_id, len(w), len(set(w)), sum(map(count, w)))] += 1
    assert bag(tokens.count_tokens(docs, queries.VOCABULARY)) == want
    assert tokens.count_tokens(empty, queries.VOCABULARY).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="abcü😀", min_size=1, max_size=8), max_size=12))
def test_token_counts_share_prefixes(found):
    pieces = {"a": -1.0, "ab": -1.5, "abc": -4.0, "b": -1.0, "c": -2.0, "bc": -2.5, "▁": -1.0, "▁a": -1.8}
    per_byte = tokens.byte_score(pieces)
    got = tokens.token_counts(found, pieces)
    assert got == {w: brute.fewest_tokens("▁" + w, pieces, per_byte) for w in found}


def _pages(spark):
    return spark.createDataFrame(
        [
            (5, "http://a.example/5", "<p>same ü</p>"),
            (3, "http://a.example/3", "<p>same ü</p>"),
            (9, None, "<p>same ü</p>"),
            (4, "http://b.example/4\r\nX: y", "alone\r\n\r\nwith breaks"),
            (6, "http://b.example/6", None),
            (2, "http://b.example/2", ""),
            (7, "http://b.example/7", "x" * 300_000),
            (7, "http://b.example/7", "x" * 300_000),
        ],
        "page_id long, url string, html string",
    )


def test_archives_round_trip(spark):
    pages = _pages(spark)
    folder = shared_dir(spark, "warc")
    index = warc.write_archives(pages.repartition(3), folder)
    found = warc.read_records(index, folder, gap_bytes=100).collect()
    first = {}
    given = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    for i, payload in sorted(given):
        first.setdefault(payload, i)
    want = Counter()
    for i, payload in given:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = first[payload] != i
        want[
            (
                i,
                len(payload),
                digest,
                "revisit" if again else "response",
                first[payload] if again else None,
                None if again else payload,
            )
        ] += 1
    got = Counter(
        (
            r.page_id,
            r.payload_bytes,
            r.payload_digest,
            r.record_type,
            r.refers_to,
            None if r.payload is None else bytes(r.payload),
        )
        for r in found
    )
    assert got == want
    one = warc.read_index(spark, folder).where("page_id = 4")
    assert bytes(warc.read_records(one, folder).first().payload) == b"alone\r\n\r\nwith breaks"


def test_archives_threshold_and_empty(spark):
    folder = shared_dir(spark, "warc")
    index = warc.write_archives(_pages(spark), folder, revisit_from=1000)
    types = {(r.page_id, r.record_type) for r in warc.read_records(index, folder).collect()}
    assert all(kind == "response" for _, kind in types)
    none = shared_dir(spark, "warc")
    index = warc.write_archives(_pages(spark).limit(0), none)
    assert warc.read_records(index, none).count() == 0
