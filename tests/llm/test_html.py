"""Page text: wrappers, main containers, blocks."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickweir.llm import html

NOISE = (
    '<header><p>Site</p></header><nav><ul><li><a href="/">Home</a></li><li>x</li></ul></nav>'
    '<div class="cookie-notice">We use cookies</div><aside>side</aside>'
)
END = '<div id="comments"><p>First!</p></div><form><p>Mail?</p></form><footer>&copy; us</footer>'


def page(main: str) -> str:
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style>"
        f"<script>var x='</p>';</script></head><body>{NOISE}{main}{END}</body></html>"
    )


def test_blocks():
    main = (
        "<article class='post'><h1>A &amp;\n B</h1><p>one <b>two</b><br>three<p>four"
        "<div class='ads'><p>Buy</p></div><ul><li>five<li>six</ul><!-- <p>no</p> -->"
        "<table><tr><td>7</td><td>8</td></tr></table>nine&lt;ten</article>"
    )
    assert html.main_text(page(main), "article.post").split("\n") == [
        "A & B",
        "one two three",
        "four",
        "five",
        "six",
        "7",
        "8",
        "nine<ten",
    ]


@pytest.mark.parametrize("text", [None, "", "   ", "<", "<p", "<script>never closed"])
def test_nothing(text):
    assert html.main_text(text, None) in ("", "<")


def test_truncated_and_stray():
    assert html.main_text("<body><article><p>one</b></div><p>two &am", None) == "one\ntwo &am"
    assert html.main_text("<article><p>one</p><p", "article") == "one"
    assert html.main_text("no tags at all", None) == "no tags at all"


@pytest.mark.parametrize(
    "odd",
    [
        "<svg viewBox='0 0 1 1'/>",
        "<svg><title>t</title><svg><path/></svg><text>no</text></svg>",
        "<svg><svg/><text>no</text></svg>",
        "<svg-icon></svg-icon>",
        "<select-menu></select-menu>",
        "<title-bar></title-bar>",
        "<nav-icon></nav-icon>",
        "<template><template>no</template>no</template>",
        "<object><object>no</object>no</object>",
        "<template><script>'</template>'</script>no</template>",
        "<SELECT><option>no</SELECT>",
    ],
)
def test_elements_left_out_end_where_they_end(odd):
    assert html.main_text(page(f"<article><p>one</p>{odd}<p>two</p></article>"), "article") == "one\ntwo"


@pytest.mark.parametrize("name", [*html._RAW, *html._NESTED])
def test_elements_without_an_end_keep_the_rest(name):
    for odd in (f"<{name}>no", f"<{name} a='1'><option>no</option>", f"<{name}><{name}>no"):
        text = page(f"<article><p>one</p>{odd}<p>two</p></article>")
        assert html.main_text(text, "article") == "one\ntwo"
        text = page(f"<article><p>one <b>{odd}</b> two</p><p>three</p></article>")
        assert html.main_text(text, "article") == "one two\nthree"


def test_very_many_elements_without_an_end():
    text = "<article>" + "<p>x</p><svg><title><select>no" * 20_000 + "<p>y</p></article>"
    assert html.main_text(page(text), "article").count("\n") == 20_000


def test_custom_elements_are_no_boilerplate():
    text = "<article><p>one</p><form-note>two</form-note><p>three</p></article>"
    assert html.main_text(page(text), "article").split("\n") == ["one", "two", "three"]


def test_wrapper_covers_its_shapes():
    few, many = (html.shape(page("<article>" + "<p>x</p>" * n + "</article>"))[0] for n in (2, 7))
    assert few == many
    other = html.shape(page("<article><h2>t</h2><p>x</p></article>"))[0]
    wrapper = html.align(few, other)
    assert html.align(wrapper, few) == wrapper or html.shared_containers(wrapper)["article"] is False
    assert ("?", ("<h2>", "#", "</h2>")) in wrapper


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "#", "</p>", "<b>", "</b>"]), max_size=30))
def test_fold_only_folds_equal_stretches(items):
    def once(folded):
        for x in folded:
            if isinstance(x, tuple):
                yield from once(x[1])
            else:
                yield x

    folded = html.fold(items)
    assert set(once(folded)) == set(items)
    assert html.align(folded, folded) == folded


def test_host_without_semantic_tags(spark):
    def plain(i: int) -> str:
        body = "".join(f"<p>text {i} {j} with a good many words in it</p>" for j in range(3 + i % 4))
        return (
            f"<html><body><div class='top'><div>menu {i}</div></div><div class='story'>{body}</div>"
            "<div class='end'>all rights</div></body></html>"
        )

    pages = spark.createDataFrame(
        [(i, f"http://Plain.example/{i}", plain(i)) for i in range(12)]
        + [
            (50, "http://other.example/1", page("<article><p>other</p></article>")),
            (51, "http://other.example/1", page("<article><p>other</p></article>")),
            (52, None, page("<main><p>no host</p></main>")),
            (53, "odd", None),
            (None, "http://other.example/2", page("<article><p>no id</p></article>")),
        ],
        "page_id long, url string, html string",
    )
    got = {r.page_id: r for r in html.extract(pages).collect()}
    assert len(got) == 17
    for i in range(12):
        want = [f"text {i} {j} with a good many words in it" for j in range(3 + i % 4)]
        assert got[i].text.split("\n") == want
        assert got[i].n_chars == len(got[i].text)
    assert (got[50].text, got[51].text, got[52].text) == ("other", "other", "no host")
    assert (got[53].text, got[53].n_chars, got[None].text) == ("", 0, "no id")
    assert html.extract(pages.limit(0)).count() == 0


def _words(seed: str, n: int) -> str:
    return " ".join(f"{seed}{k}" for k in range(n))


@pytest.mark.parametrize("paras", [1, 3])
def test_body_in_several_containers(spark, paras):
    def pages(i: int):
        top, end = "<div class='top'>our site</div>", "<div class='end'>all rights</div>"
        lead = f"<div class='lead'>{_words(f'lead{i}x', 4)}</div>"
        text = "".join(f"<div class='text'>{_words(f't{i}y{j}z', 30)}</div>" for j in range(paras))
        bio = f"<div class='bio'>{_words(f'bio{i}x', 12)}</div>"
        para = "".join(f"<div class='para'>{_words(f'p{i}y{j}z', 9)}</div>" for j in range(3 + i))
        card = "".join(
            "<li>" + f"<b>{i}</b><i>x</i>" * 5 + f"<u>{_words(f'c{i}y{j}z', 40)}</u></li>" for j in range(4 + i)
        )
        yield f"wrap{i}", "http://wrap/", f"{top}<div class='wrap'>{lead}{text}</div>{end}", [
            f"lead{i}x3", f"t{i}y{paras - 1}z29"
        ], ["our", "rights"]
        yield f"bio{i}", "http://bio/", f"{top}{para}{bio}{end}", [f"p{i}y0z8", f"p{i}y{2 + i}z8"], []
        yield f"card{i}", "http://card/", f"<div class='a'><ul>{card}</ul></div><div class='b'>{_words(f'b{i}x', 9)}</div>", [
            f"c{i}y0z39", f"c{i}y{3 + i}z39"
        ], []

    cases = [case for i in range(8) for case in pages(i)]
    frame = spark.createDataFrame(
        [(k, c[1] + c[0], f"<html><body>{c[2]}</body></html>") for k, c in enumerate(cases)],
        "page_id long, url string, html string",
    )
    got = {r.page_id: r.text.split() for r in html.extract(frame).collect()}
    for k, (name, _, _, inside, outside) in enumerate(cases):
        assert set(inside) <= set(got[k]), name
        assert not set(outside) & set(got[k]), name


def test_long_groups_fold():
    card = [f"<x{k}>" for k in range(20)]
    assert html.fold(["a", *card * 2, "b"]) == html.fold(["a", *card * 5, "b"]) == ["a", ("+", tuple(card)), "b"]
    assert html.fold([("+", tuple(card)), *card]) == [("+", tuple(card))]


def test_container_of_some_pages_is_not_the_hosts(spark):
    side = "<div class='side'>see also</div>"
    long = [f"<div class='long'>{_words(f'l{i}x', 4000)}</div>{side}" for i in range(3)]
    short = [f"<p>{_words(f's{i}x', 20)}</p>{side}" for i in range(6)]
    both = [f"<p>{_words(f'b{i}x', 20)}</p><div class='long'>note {i}</div>{side}" for i in range(3)]
    frame = spark.createDataFrame(
        [(k, f"http://some/{k}", f"<html><body>{x}</body></html>") for k, x in enumerate(long + short + both)],
        "page_id long, url string, html string",
    )
    got = {r.page_id: r.text.split() for r in html.extract(frame).collect()}
    assert all(f"l{i}x3999" in got[i] for i in range(3))
    assert all(f"s{i}x19" in got[3 + i] for i in range(6))
    assert all(f"b{i}x19" in got[9 + i] for i in range(3))
