"""Main text of web pages by wrappers: union-free expressions per host.

1. Every page becomes a stream of tags and text slots (``#``). Adjacent equal
   stretches fold into one repeated group, so that pages that differ only in
   the number of paragraphs or menu entries have the same shape.
2. The distinct shapes of a host are aligned one after the other with the
   wrapper so far. Where they differ, a stretch that only one side has becomes
   optional, stretches that repeat a group join the group, and texts are slots;
   there are no alternatives. A host's shapes are first spread over ``SALTS``
   partial wrappers, each folded as a stream that holds one wrapper and one
   shape, and those are then aligned with each other.
3. The wrapper tells which containers all pages of the host share. The main one
   is the article, or else the main element, or else the lowest container that
   holds the text, its inner containers' included, that differs between pages of
   the host: most of it, and at least ``COVER`` of it, or else the body.
4. Each page gives the blocks of its host's main container. Within it only
   boilerplate elements (by tag, role, or class and id cues) are left out; text
   is kept even where all pages of the host have it. A page without the
   container falls back to its own article, main element or whole body.

Shapes and sums per host merge in the map tasks; pages themselves are not
shuffled while the table of main containers fits a broadcast (it is measured),
and are joined with hot hosts salted beyond that.

Defined results: a null html gives an empty text, a null or odd URL belongs to
the host without a name; repeated rows get equal results; truncated pages give
what they have, a tag cut off at the end is dropped; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.common import send_code
from clickweir.operators.joins import fits_broadcast, salted_join
from clickweir.workspace import materialise

send_code(__name__)

SALTS, PERIODS = 64, 16
COVER = 0.95  # a menu that differs by page may stand outside the main container

# Elements by their role in a page.
_RAW = "noscript textarea title iframe".split()  # left out, like scripts and styles
_NESTED = "template svg object select".split()  # left out too, but they may nest
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINERS = frozenset("article main section div td body".split())
_BOILERPLATE = frozenset("nav aside footer form button dialog menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
_CUES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer menu modal nav navbar navigation newsletter notice notices "
    "popup promo related share sharing sidebar social sponsor sponsored subscribe widget".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<code>script|style)(?=[\s/>])[^>]*>.*?(?:</(?P=code)\s*>|\Z)"
    rf"|<(?P<left>{'|'.join(_RAW + _NESTED)})(?=[\s/>])(?P<inner>[^>]*)>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:._-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NESTING = {
    name: re.compile(
        rf"<!--.*?(?:-->|\Z)|<(?P<raw>script|style)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
        rf"|<(?P<end>/?){name}(?=[\s/>])(?P<inner>[^>]*)>",
        re.S | re.I,
    )
    for name in _NESTED
}
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW}
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(_BLOCKS))})(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(
    r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I
)


class _Element:
    __slots__ = ("boilerplate", "key", "name")

    def __init__(self, name: str, rest: str):
        self.name = name
        found = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(rest)}
        named = f"{found.get('class', '')} {found.get('id', '')}"
        self.boilerplate = (
            name in _BOILERPLATE
            or found.get("role") in _ROLES
            or any(w in _CUES for w in re.split(r"[\s_-]+", named))
        )
        classes = ".".join(sorted(set(found.get("class", "").split())))
        main = found.get("role") == "main"
        self.key = "main" if main else f"{name}.{classes}" if classes else name


class _LeftOut:
    """Where a page goes on after an element that is left out.

    One that has no end tag ends before the next tag of a block, or with the
    element around it, whichever is first. What is known of a page is kept, so
    very many elements without an end cost one pass per name.
    """

    def __init__(self, html: str):
        self.html = html
        self.ends: dict[str, dict[int, int]] = {}  # of elements that may nest, by their start
        self.endless: set[str] = set()  # raw elements without a further end tag

    def _nested_ends(self, name: str) -> dict[int, int]:
        found, opened = {}, []
        for m in _NESTING[name].finditer(self.html):
            if m["inner"] is None:
                continue
            if m["end"]:
                if opened:
                    found[opened.pop()] = m.end()
            elif name != "svg" or not m["inner"].endswith("/"):
                opened.append(m.end())
        return found

    def past(self, at: int, name: str, inner: str, parent: str | None) -> int:
        if name == "svg" and inner.endswith("/"):
            return at
        if name in _NESTING:
            if name not in self.ends:
                self.ends[name] = self._nested_ends(name)
            if at in self.ends[name]:
                return self.ends[name][at]
        elif name not in self.endless:
            if m := _RAW_END[name].search(self.html, at):
                return m.end()
            self.endless.add(name)
        block = _BLOCK_TAG.search(self.html, at)
        until = block.start() if block else len(self.html)
        if parent:
            if m := re.compile(rf"</{re.escape(parent)}(?=[\s/>])", re.I).search(self.html, at, until):
                return m.start()
        return until


def events(html: str) -> Iterator[tuple[str, object]]:
    """("open", element), ("close", element), ("text", text) and ("break", name) of a page.

    Elements are closed as they must be: by their end tag, by that of an element
    around them, or, for paragraphs and entries, by the next of their kind.
    """
    stack: list[_Element] = []
    left_out = _LeftOut(html)
    place = 0
    while m := _TOKEN.match(html, place):
        place = m.end()
        if m["text"] is not None:
            yield "text", m["text"]
            continue
        if m["left"] is not None:
            parent = stack[-1].name if stack else None
            place = left_out.past(place, m["left"].lower(), m["inner"], parent)
            continue
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name), None)
            if at is None:
                yield "break", name
                continue
            while len(stack) > at:
                yield "close", stack.pop()
            continue
        if name in _VOID:
            yield "break", name
            continue
        closes = {"li": "li", "td": "td", "th": "th", "tr": "tr", "dd": "dd", "dt": "dt"}.get(name)
        if name in _BLOCKS:
            # A block ends a paragraph that is open; an entry ends the entry before it.
            for kind in filter(None, ("p", closes)):
                at = None
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].name == kind:
                        at = k
                        break
                    if stack[k].name in _BLOCKS:
                        break
                while at is not None and len(stack) > at:
                    yield "close", stack.pop()
        element = _Element(name, m["rest"])
        if not m["rest"].endswith("/") or name in _BLOCKS:
            stack.append(element)
            yield "open", element
    while stack:
        yield "close", stack.pop()


def _fold_long(items: list) -> list:
    """The first stretch of more than ``PERIODS`` items that repeats, folded."""
    number: dict = {}
    codes = np.array([number.setdefault(x, len(number)) for x in items])
    for period in range(PERIODS + 1, len(items) // 2 + 1):
        same = codes[:-period] == codes[period:]
        if np.count_nonzero(same) < period:
            continue
        ends = np.flatnonzero(np.concatenate(([True], ~same, [True])))
        long = np.flatnonzero(np.diff(ends) > period)
        if len(long):
            begin = int(ends[long[0]])
            times = (int(ends[long[0] + 1]) - begin - 1) // period + 1
            group = ("+", tuple(items[begin : begin + period]))
            return [*items[:begin], group, *items[begin + period * times :]]
    return items


def fold(items: list) -> list:
    """Adjacent equal stretches as one repeated group ("+", stretch), innermost first."""
    while True:
        before = len(items)
        for period in range(1, PERIODS + 1):
            out, k = [], 0
            while k < len(items):
                group = items[k : k + period]
                end = k + period
                while len(group) == period and items[end : end + period] == group:
                    end += period
                if end > k + period:
                    one = group[0]
                    again = period == 1 and isinstance(one, tuple)
                    out.append(one if again else ("+", tuple(group)))
                    k = end
                else:
                    out.append(items[k])
                    k += 1
            items = out
        # A group next to one more of its stretches takes it in.
        out, groups = [], []
        for item in items:
            while groups and groups[-1] >= len(out):
                groups.pop()
            out.append(item)
            if isinstance(item, tuple) and item[0] == "+":
                size = len(item[1])
                while tuple(out[-1 - size : -1]) == item[1]:
                    del out[-1 - size : -1]
                while groups and groups[-1] >= len(out) - 1:
                    groups.pop()
                groups.append(len(out) - 1)
            else:
                for at in reversed(groups):
                    size = len(out) - 1 - at
                    if len(out[at][1]) == size and out[at][1] == tuple(out[-size:]):
                        del out[-size:]
                        break
        items = out
        if len(items) == before:
            items = _fold_long(items)
        if len(items) == before:
            return items


def shape(html: str) -> tuple[list, dict[tuple, tuple[int, int]]]:
    """The folded tag and slot stream, and length and checksum of the text by open containers."""
    items: list = []
    texts: dict[tuple, tuple[int, int]] = {}
    containers: list[str] = ["body"]
    skipped = 0
    for kind, value in events(html):
        if kind == "open":
            items.append(f"<{value.key}>")
            skipped += value.boilerplate
            if value.name in _CONTAINERS:
                containers.append(value.key)
        elif kind == "close":
            items.append(f"</{value.key}>")
            skipped -= value.boilerplate
            if value.name in _CONTAINERS:
                containers.pop()
        elif kind == "text" and value.strip():
            if not items or items[-1] != "#":
                items.append("#")
            if not skipped:
                around = tuple(dict.fromkeys(containers))
                n, check = texts.get(around, (0, 0))
                texts[around] = n + len(value), zlib.crc32(value.encode("utf-8", "replace"), check)
    return fold(items), texts


def _first(item) -> str:
    while isinstance(item, tuple):
        item = item[1][0] if item[1] else ""
    return item


def _key(item) -> str:
    return item if isinstance(item, str) else f"{item[0]}{_first(item)}"


def _optional(items: list) -> list:
    if not items:
        return []
    if len(items) == 1 and isinstance(items[0], tuple) and items[0][0] == "?":
        return list(items)
    return [("?", tuple(items))]


def _resolve(a: list, b: list) -> list:
    """One stretch for two that differ: a common group, or each of them optional."""
    for one, other in ((a, b), (b, a)):
        if len(one) == 1 and isinstance(one[0], tuple) and other:
            sign, inner = one[0]
            size = len(inner)
            at = next((k for k in range(len(other)) if other[k : k + size] == list(inner)), None)
            if at is not None:  # the other side has the stretch once, among more
                return [*_optional(other[:at]), one[0], *_optional(other[at + size :])]
            if sign == "+" and _first(one[0]) == _first(other[0]):
                return [("+", tuple(align(list(inner), other)))]
            if sign == "?":
                return [("?", tuple(align(list(inner), other)))]
    return _optional(a) + _optional(b)


def align(a: list, b: list) -> list:
    """The least expression of this kind found that covers both."""
    if a == b:
        return a
    out: list = []
    matcher = SequenceMatcher(None, [_key(x) for x in a], [_key(x) for x in b], autojunk=False)
    for tag, i, j, k, m in matcher.get_opcodes():
        if tag != "equal":
            out += _resolve(a[i:j], b[k:m])
            continue
        for x, y in zip(a[i:j], b[k:m]):
            if x == y or isinstance(x, str):
                out.append(x)
            else:
                out.append((x[0], tuple(align(list(x[1]), list(y[1])))))
    return fold(out)


def _as_tuples(value):
    return (value[0], tuple(map(_as_tuples, value[1]))) if isinstance(value, list) else value


def load_shape(text: str) -> list:
    return [_as_tuples(x) for x in json.loads(text)]


def shared_containers(
    wrapper: list, repeated: bool = False, optional: bool = False
) -> dict[str, bool]:
    """Container keys all pages of a wrapper share, and whether only within repeated groups.

    ``optional`` adds those of optional groups, which only some of the pages have.
    """
    found: dict[str, bool] = {}
    for item in wrapper:
        if isinstance(item, str):
            name = item.strip("<>")
            if not item.startswith("</") and name.split(".")[0] in _CONTAINERS:
                found[name] = found.get(name, True) and repeated
        elif item[0] == "+" or optional:
            inner = shared_containers(list(item[1]), repeated or item[0] == "+", optional)
            for name, only in inner.items():
                found[name] = found.get(name, True) and only
    return found


def main_container(wrapper: list, texts: list[tuple[list[str], int, bool]]) -> str:
    """The key of the container that has the main text on this host.

    ``texts``: containers around a text, its length, whether it differs by page.
    """
    found, some = shared_containers(wrapper), shared_containers(wrapper, optional=True)
    held, differing = Counter(), Counter()
    for around, n, differs in texts:
        for key in set(around):
            held[key] += n
            differing[key] += n * differs
    for wanted in ("article", "main"):
        semantic = [k for k in found if k.split(".")[0] == wanted]
        if semantic:
            return max(semantic, key=lambda k: (held[k], k))
        if any(k.split(".")[0] == wanted for k in some):
            return "body"  # each page by its own elements
    counted = differing if differing["body"] else held
    covering = [
        k for k in found
        if k.split(".")[0] != "body" and counted[k] >= COVER * counted["body"] > 0
    ]
    return max(covering, key=lambda k: (counted[k], -held[k], k), default="body")


def _blocks_in(html: str, wanted) -> tuple[bool, list[str]]:
    """Whether an element is ``wanted``, and the blocks of all that are."""
    blocks: list[str] = []
    parts: list[str] = []
    inside = skipped = 0
    met = False
    opened: list[tuple[object, bool, bool]] = []

    def end_block():
        line = " ".join(unescape("".join(parts)).split())
        if line:
            blocks.append(line)
        parts.clear()

    for kind, value in events(html):
        if kind == "open":
            if value.name in _BLOCKS:
                end_block()
            main = not skipped and wanted(value)
            skip = value.boilerplate and not main
            met |= main
            inside += main
            skipped += skip
            opened.append((value, main, skip))
        elif kind == "close":
            if value.name in _BLOCKS:
                end_block()
            _, main, skip = opened.pop()
            inside -= main
            skipped -= skip
        elif kind == "break":
            if value in _BLOCKS:
                end_block()
            elif inside and not skipped:
                parts.append(" ")
        elif inside and not skipped:
            parts.append(value)
    end_block()
    return met, blocks


def main_text(html: str | None, container: str | None) -> str:
    """The text blocks of the main container, or of the page's own best guess."""
    html = html or ""
    # The page header is boilerplate, a header within the main element is part of it.
    tests = [
        lambda e: e.key == container,
        lambda e: e.name == "article",
        lambda e: e.key.split(".")[0] == "main",
    ]
    if container in (None, "body"):
        tests = tests[1:]
    for wanted in tests:
        met, blocks = _blocks_in(html, wanted)
        if met:
            return "\n".join(blocks)
    html = re.sub(r"<header\b.*?(?:</header\s*>|\Z)", " ", html, flags=re.S | re.I)
    met, blocks = _blocks_in(html, lambda e: e.name == "body")
    return "\n".join(blocks if met else _blocks_in(f"<body>{html}", lambda e: e.name == "body")[1])


_SHAPES = pa.schema(
    [
        ("host", pa.string()),
        ("shape", pa.string()),
        (
            "texts",
            pa.list_(
                pa.struct([("around", pa.string()), ("n", pa.int64()), ("check", pa.int64())])
            ),
        ),
    ]
)
_WRAPPERS = pa.schema([("host", pa.string()), ("salt", pa.int32()), ("shape", pa.string())])
_TEXTS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("text", pa.string()),
        ("n_chars", pa.int64()),
    ]
)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            items, texts = shape(html.as_py() or "")
            counted = [
                {"around": json.dumps(k), "n": n, "check": check}
                for k, (n, check) in sorted(texts.items())
            ]
            rows.append((host, json.dumps(items), counted))
        yield _batch(_SHAPES, rows)


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per run of equal (host, salt); one wrapper is held at a time."""
    of, wrapper = None, []
    for batch in batches:
        done = []
        for host, salt, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (host, salt) != of:
                if of is not None:
                    done.append((*of, json.dumps(wrapper)))
                of, wrapper = (host, salt), load_shape(text)
            else:
                wrapper = align(wrapper, load_shape(text))
        yield _batch(_WRAPPERS, done)
    if of is not None:
        yield _batch(_WRAPPERS, [(*of, json.dumps(wrapper))])


def infer_wrappers(shapes: DataFrame) -> DataFrame:
    """(host, shape): one wrapper per host of ``shapes`` (host, shape)."""
    kinds = "host string, salt int, shape string"
    salt = F.pmod(F.xxhash64("shape"), F.lit(SALTS)).cast("int").alias("salt")
    distinct = shapes.select("host", salt, "shape").distinct()
    parts = (
        distinct.repartition("host", "salt")
        .sortWithinPartitions("host", "salt", "shape")
        .mapInArrow(_aligned, kinds)
    )
    whole = (
        parts.select("host", F.lit(0).alias("salt"), "shape")
        .repartition("host")
        .sortWithinPartitions("host", "shape")
        .mapInArrow(_aligned, kinds)
    )
    return whole.select("host", "shape")


def main_containers(wrappers: DataFrame, texts: DataFrame) -> DataFrame:
    """(host, container) from wrappers and the text per (host, around) over all pages."""
    out = pa.schema([("host", pa.string()), ("container", pa.string())])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (
                    host,
                    main_container(
                        load_shape(text),
                        [(json.loads(c["around"]), c["n"], c["differs"]) for c in texts or ()],
                    ),
                )
                for host, text, texts in zip(*(c.to_pylist() for c in batch.columns))
            ]
            yield _batch(out, rows)

    by_host = texts.groupBy("host").agg(
        F.collect_list(F.struct("around", "n", "differs")).alias("texts")
    )
    joined = wrappers.join(by_host, "host", "left").select("host", "shape", "texts")
    return joined.mapInArrow(choose, "host string, container string")


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    given = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(host, F.lit("")).alias("host"),
        F.col(html).alias("html"),
    )
    shapes = materialise(
        given.select("host", "html").mapInArrow(
            _shapes,
            "host string, shape string, texts array<struct<around:string,n:bigint,check:bigint>>",
        )
    )
    by_place = (
        shapes.select("host", F.inline("texts"))
        .groupBy("host", "around")
        .agg(
            F.sum("n").alias("n"),
            ((F.count("*") == 1) | (F.min("check") != F.max("check"))).alias("differs"),
        )
    )
    containers = materialise(main_containers(infer_wrappers(shapes), by_place))
    if fits_broadcast(containers):
        placed = given.join(F.broadcast(containers), "host", "left")
    else:
        placed = salted_join(given, containers, ["host"], spread_by=["page_id", "url"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, address, page, container in zip(*batch.columns):
                text = main_text(page.as_py(), container.as_py())
                rows.append((i.as_py(), address.as_py(), text, len(text)))
            yield _batch(_TEXTS, rows)

    return placed.select("page_id", "url", "html", "container").mapInArrow(
        texts, "page_id bigint, url string, text string, n_chars bigint"
    )
