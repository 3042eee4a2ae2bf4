"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits,
schemes and identifier cues. At each anchor a deterministic parser expands to
the left and right over the characters its kind allows and validates what it
has: domains, octets, check digits, lengths. A failing match is dropped and its
characters are not tried again for that kind, as with a leftmost search without
overlap. Rows are independent, so there is no shuffle and no state beyond one
text at a time.

Defined results: a null text is an empty one and has no spans; repeated rows
get equal results; an empty table gives an empty result; other columns are
never read. Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.common import send_code

send_code(__name__)

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "handle", "login")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*")
_DIAL = re.compile(r"[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOGIN = re.compile(r"[^\s/:@]+:[^\s/@]+@[A-Za-z0-9.-]+")
_HANDLE = re.compile(r"[A-Za-z0-9_]{2,}")

# Schemes that can carry a login, and cues before an identifier.
_SCHEMES = ("http://", "https://", "ftp://", "ssh://")
_IBAN_CUES = ("IBAN", "iban", "Iban")
_SSN_CUES = ("SSN", "ssn", "Social Security", "social security")
_HANDLE_CUES = ("account @", "user @", "handle @", "Account @", "User @", "Handle @")


def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for anchor in "@+0123456789":
        found.add_word(anchor, ("digit" if anchor.isdigit() else anchor, 1))
    for kind, cues in (
        ("login", _SCHEMES),
        ("iban", _IBAN_CUES),
        ("ssn", _SSN_CUES),
        ("handle", _HANDLE_CUES),
    ):
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _iban_good(text: str) -> bool:
    code = text.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _after_cue(text: str, at: int) -> int:
    """Where the value after a cue begins: past all separators."""
    end = at
    while end < len(text) and text[end] in " :#=\t":
        end += 1
    return end


def find_spans(text: str, anchors: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Validated spans by kind, each list in order and without overlap."""
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    past = dict.fromkeys((*KINDS, "dotted"), 0)  # where each kind may go on
    for last, (anchor, length) in anchors.iter(text):
        at = last - length + 1
        if anchor == "@":
            left = at
            while left > past["email"] and text[left - 1] in _LOCAL:
                left -= 1
            if left < at and (m := _DOMAIN.match(text, at + 1)):
                spans["email"].append((left, m.end()))
                past["email"] = m.end()
        elif anchor == "digit":
            if at >= past["dotted"]:
                m = _DOTTED.match(text, at)
                past["dotted"] = m.end()
                starts, parts = at, m.group().split(".")
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k : k + 4]
                    end = starts + sum(map(len, four)) + 3
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                        spans["ip"].append((starts, end))
                    starts = end + 1
            if at >= past["card"]:
                m = _DIGITS.match(text, at)
                past["card"] = m.end()
                digits = _only_digits(m.group())
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    spans["card"].append((at, m.end()))
        elif anchor == "+":
            if at >= past["phone"] and (m := _DIAL.match(text, at + 1)):
                past["phone"] = m.end()
                if 9 <= len(_only_digits(m.group())) <= 15:
                    spans["phone"].append((at, m.end()))
        else:
            begin = last + 1 if anchor in ("login", "handle") else _after_cue(text, last + 1)
            if begin < past[anchor]:
                continue
            pattern = {"iban": _IBAN, "ssn": _SSN, "login": _LOGIN, "handle": _HANDLE}[anchor]
            m = pattern.match(text, begin)
            if m and (anchor != "iban" or _iban_good(m.group())):
                spans[anchor].append((begin, m.end()))
                past[anchor] = m.end()
    return spans


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(f"n_{kind}", pa.int64()) for kind in BASE_KINDS],
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = _anchors()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            spans = find_spans(text.as_py() or "", anchors)
            named = {k: [f"{k}:{a}:{b}" for a, b in found] for k, found in spans.items()}
            base = ",".join(x for k in BASE_KINDS for x in named[k])
            rows.append(
                (
                    doc_id,
                    *[len(named[k]) for k in BASE_KINDS],
                    hashlib.sha256(base.encode()).hexdigest(),
                    ",".join(x for k in KINDS for x in named[k]),
                )
            )
        columns = list(zip(*rows)) if rows else [[] for _ in _OUT]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT
        )


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the base kinds' counts, a digest of the base spans, and all spans as text."""
    counts = ", ".join(f"n_{kind} bigint" for kind in BASE_KINDS)
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        _scan, f"doc_id bigint, {counts}, base_sha256 string, spans string"
    )
