"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import combinations

import xxhash

_UPPER = {k: k + 32 for k in range(ord("A"), ord("Z") + 1)}
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _WORD.findall(text or "")


def lower(text):
    return (text or "").translate(_UPPER)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if seen[x] > 1 for j in range(3)}
    lines, repeated = set(), 0
    for line in text.split("\n"):
        if words(line):
            repeated += line in lines
            lines.add(line)
    return (
        len(w),
        sum(map(len, w)),
        sum(text.count(s) for s in "#*$%&|<>"),
        repeated,
        len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


def js_distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    terms = [x * math.log2(x / y) for s in (p, q) for x, y in zip(s, m) if x > 0]
    return math.sqrt(max(0.0, sum(terms) / 2))


def secrets(text):
    text = text or ""
    assign = re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        re.ASCII,
    )
    spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    for rank, kind, pattern, least in (
        (1, "access", r"AKIA[A-Z0-9]+", 20),
        (2, "hex", r"[0-9a-f]+", 24),
    ):
        spans += [
            (m.start(), rank, kind, m.end())
            for m in re.finditer(pattern, text)
            if len(m[0]) >= least
        ]
    n = Counter(kind for _, _, kind, _ in spans)
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
    return n["assign"], n["access"], n["hex"], sha256(joined)


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def personal(text):
    text = text or ""

    def digits(s):
        return re.sub(r"[^0-9]", "", s)

    tests = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (
            "ip",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda s: all(int(x) <= 255 for x in s.split(".")),
        ),
        (
            "card",
            r"[0-9]([\x20-]?[0-9])+",
            lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)),
        ),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    spans = [
        (kind, m.start(), m.end())
        for kind, pattern, good in tests
        for m in re.finditer(pattern, text)
        if good(m[0])
    ]
    n = Counter(kind for kind, _, _ in spans)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return n["email"], n["ip"], n["card"], n["phone"], sha256(joined)


def fingerprint(text):
    w = words(lower(text))
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def contamination(docs, items, window=13):
    """(n_words, n_hit, item ids) per document."""
    windows = defaultdict(set)
    for item, text in items:
        w = _ALNUM.findall(lower(text))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add(item)
    out = []
    for _, text in docs:
        w, hit, found = _ALNUM.findall(lower(text)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((len(w), len(hit), ids))
    return out


def shingles(line, k=8):
    return {line[i : i + k] for i in range(len(line) - k + 1)} or {line}


def line_groups(lines, k=8, similar=0.8):
    """Component of each distinct line, by its least member, over all pairs."""
    sets = {line: shingles(line, k) for line in lines}
    edges = [
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b])
    ]
    return components(sets, edges)


def fewest_tokens(word, pieces, per_byte):
    """Tokens of the best segmentation of one pre-token."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        options = [(best[end - 1][0] + n * per_byte, best[end - 1][1] + n)]
        options += [
            (best[b][0] + pieces[word[b:end]], best[b][1] + 1)
            for b in range(end)
            if word[b:end] in pieces
        ]
        best.append(max(options, key=lambda x: (x[0], -x[1])))
    return best[-1][1]
