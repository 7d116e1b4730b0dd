"""Extraction on pages of known content."""

import html
import random
import re
import time

import pytest

from changeflow.llm import html_extract as H
from changeflow.llm.html_extract import extract, main_text
from tests.llm.conftest import SF

PROSE = "This is a paragraph of some length, with commas, and enough words to count as the prose of an article."
MORE = "Another paragraph follows here, it is long as well, and it belongs to the same story as the first one."


def test_pages_of_the_table(spark):
    got = {r["page_id"]: r for r in extract(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for r in got.values():
        body = r["html"].split("<article>")[1].split("</article>")[0]
        blocks = re.split(r"</?(?:p|h1)>", body)
        plain = [" ".join(html.unescape(re.sub(r"<[^>]*>|<[^>]*$", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks]
        assert r["text"] == "\n".join(x for x in plain if x)


@pytest.mark.parametrize(("page", "want"), [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("<p", ""),
    (f"<div class=sidebar><p>{MORE}</p></div><div id=c><p>{PROSE}<p>Two &amp; three</div><div id=comments><p>{MORE} {MORE}</p></div>", f"{PROSE}\nTwo & three"),
    (f"<nav><a href=x>Home</a></nav><div><h2>Title</h2><div><p>{PROSE}</p></div><div><p>{MORE}</p></div></div><footer>f</footer>", f"Title\n{PROSE}\n{MORE}"),
    (f"<main><header><h1>Head</h1><p>By someone</p></header><p>{PROSE}</p><aside>{MORE}</aside><form><p>Mail</p></form><script>var a='<p>';</script></main>", f"Head\n{PROSE}"),
    (f"<body><div class='cookie-notice'><p>{MORE}</p></div><article><p>a\n\n  b&nbsp;c<br>d &lt;e&gt; &#233;</p><!-- <p>x</p> --><ul><li>one</li><li>two</li></ul></article>", "a b c d <e> é\none\ntwo"),
    (f"<table><tr><td><p>{PROSE}</p></td></tr></table>", PROSE),
    (f"<div><p>{PROSE}</p><ul><li><a href=1>one link</a></li><li><a href=2>two link</a></li></ul></div>", PROSE),
    (f"<article><p>{PROSE}</p><p>cut <a href='x", f"{PROSE}\ncut"),
    ("<div><p>Short.</p></div>", "Short."),
    (f"<article><style>p{{}}</style><p style='display:none'>{MORE}</p><p>{PROSE} 1 < 2</p></article>", f"{PROSE} 1 < 2"),
])
def test_cases(page, want):
    assert main_text(page) == want


def test_odd_rows(spark):
    long = "<article>" + f"<p>{PROSE}</p>" * 20_000 + "</article>"
    deep = "<div>" * 5000 + f"<p>{PROSE}</p>"
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, long, "x"), (3, deep, None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extract(df)
    assert got.columns == df.columns and got.count() == len(rows)
    by = {r["page_id"]: r["text"] for r in got.collect()}
    assert by[1] == by[2] == "" and by[3] == PROSE and by[None] == "\n".join([PROSE] * 20_000)
    assert extract(df.limit(0)).count() == 0


FIVE = "".join(f"<p>{PROSE} {i}</p>" for i in range(5))
PLAIN = "\n".join(f"{PROSE} {i}" for i in range(5))


@pytest.mark.parametrize("page", [
    f'<div class="content-sidebar-wrap">{FIVE}</div>', f'<div class="page has-sidebar">{FIVE}</div>', f'<div class="no-comments">{FIVE}</div>',
    f'<article class="post category-legal">{FIVE}</article>', f'<article class="post tag-social">{FIVE}</article>',
    f'<div class="sidebar">{FIVE}</div>',  # all there is
    f'<div class="main-sidebar"><p>{MORE}</p></div><div>{FIVE}</div><div class="site-footer"><p>{MORE}</p></div>',
])
def test_class_names_that_mislead(page):
    assert main_text(page) == PLAIN


def test_two_articles_plain_text_and_references():
    assert main_text(f"<main><article>{FIVE}</article><article><p>{MORE}</p><p>{MORE}</p></article></main>".replace("main>", "div>")) == f"{PLAIN}\n{MORE}\n{MORE}"
    assert main_text("just  some text,\nwithout a tag &amp; more") == "just some text, without a tag & more"
    assert main_text(f"<article>{FIVE}<ul><li><a href=1>First source</a></li></ul></article>") == f"{PLAIN}\nFirst source"


def test_points_match_plain_sums():
    """Every container's points, from the definition, on random trees."""
    rng = random.Random(4)

    def page(depth: int) -> str:
        if depth == 0 or rng.random() < 0.3:
            return rng.choice([f"<p>{PROSE[:rng.randint(1, 100)]}</p>", f"<b>x, {MORE[:20]}</b>", f"<p>{MORE} <a href=x>{PROSE[:rng.randint(1, 100)]}</a></p>", "text, here "])
        return f"<{(t := rng.choice(['div', 'section', 'span', 'blockquote']))}>" + "".join(page(depth - 1) for _ in range(rng.randint(1, 3))) + f"</{t}>"

    def text_of(node, block=True):
        """(characters, link characters, commas) as they count for a node."""
        chars = linked = commas = 0
        for k in node.kids:
            if isinstance(k, str):
                if not k.isspace():
                    chars, commas = chars + len(k), commas + k.count(",")
            else:
                c, li, co = text_of(k)
                chars, linked, commas = chars + c, linked + li, commas + (co if k.tag not in H.BLOCK else 0)
        return chars, chars if node.tag == "a" else linked, commas

    for _ in range(200):
        order = H._score(H._parse("".join(page(5) for _ in range(3))))
        want = {id(n): 0.0 for n in order}
        for n in order:
            chars, linked, commas = text_of(n)
            direct = any(isinstance(k, str) and not k.isspace() for k in n.kids)
            if not chars or not (n.tag in H.PARAGRAPH or ((n.tag in H.BLOCK or n.parent is None) and direct)) or linked / chars > H.LINKED:
                continue
            worth = (min(chars, 25) / 25 + commas + min(chars / 100, 3)) * (1 - linked / chars)
            up, share, steps = (n.parent if n.tag in H.PARAGRAPH else n), 1.0, 0
            while up is not None:
                if up.tag in H.BLOCK or up.parent is None:
                    want[id(up)] += worth * share
                    steps += 1
                    share = 0.5 if steps == 1 else share / 3
                up = up.parent
        for n in order:
            assert n.points == pytest.approx(want[id(n)])


@pytest.mark.parametrize("page", ["<div>a, b" * 110_000, "<div>" * 100_000 + "</x>" * 125_000, "<b>" * 50_000 + "<h1>x</h1>" * 20_000, "<ul><li>" * 60_000, "<p>x" * 100_000])
def test_deep_pages_take_linear_time(page):
    begun = time.time()
    main_text(page)
    assert time.time() - begun < 20  # some 2 s; by squares it would be hours
