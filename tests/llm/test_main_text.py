"""Main text: minimum cuts against all labellings, pages with known text, broken markup."""

import html
import itertools
import random
import re
import time

import pytest

from loomstar.llm import main_text
from loomstar.llm.html_blocks import read_page
from loomstar.llm.mincut import least_cost
from loomstar.llm.queries import QUERIES


def test_least_cost_against_all_labellings():
    rng = random.Random(3)
    for _ in range(1500):
        n = rng.randint(0, 9)
        unary = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 6)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4]

        def cost(label):
            return sum(abs(u) for u, x in zip(unary, label) if u and (u > 0) != x) + sum(w for a, b, w in edges if label[a] != label[b])

        got = least_cost(unary, edges)
        assert (cost(got), sum(got)) == min((cost(x), sum(x)) for x in itertools.product([False, True], repeat=n))


def test_an_uncertain_block_follows_its_neighbours():
    chain = [(k, k + 1, 5) for k in range(4)]
    assert least_cost([9, -1, 8, -2, 9], chain) == [True] * 5
    assert least_cost([-9, 1, -8, 2, -9], chain) == [False] * 5


WORDS = "bridge council river morning paper story people street garden winter letter window market summer".split()


def sentence(rng, n=14):
    return " ".join(rng.choices(WORDS, k=n)).capitalize() + "."


@pytest.mark.parametrize("named", [True, False])
def test_pages_with_known_text(named):
    """The article's blocks come back, whatever stands around and between them; with and without telling names."""
    rng = random.Random(7)
    for _ in range(60):
        name = (lambda s: f' class="{s}"') if named else (lambda s: "")
        blocks = [sentence(rng, rng.choice([3, 15, 40])) if k % 4 != 3 else sentence(rng, 2) for k in range(rng.randint(4, 12))]
        blocks[0], blocks[-1] = sentence(rng, 20), sentence(rng, 20)
        body = ""
        for k, b in enumerate(blocks):
            body += f"<p>{html.escape(b)} &amp; <b>so</b>&nbsp;on<br>\n  <i>x</i></p>"
            if named and k % 5 == 2:
                body += f'<div{name("ad")}>{sentence(rng)}</div><script>var a = "</p>";</script><aside><p>{sentence(rng, 30)}</p></aside>'
        links = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.sample(WORDS, 6))
        around = f'<div{name("cookie-notice")}>We use cookies. <button>OK</button></div>' if named else ""
        tail = f'<section id="comments"><h3>Comments</h3><article{name("comment")}><p>{sentence(rng, 30)}</p></article></section>' if named else ""
        page = f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{around}<nav><ul>{links}</ul></nav><div{name("post-content")}>{body}</div>{tail}<footer>&copy; {sentence(rng, 5)}</footer>'
        assert main_text.main_text(page)[0] == "\n".join(f"{b} & so on x" for b in blocks)


def texts(page):
    return [b.text for b in read_page(page).blocks]


def test_reading_markup():
    assert texts('a < b <a title="x>y">c</a><!-- > --> d<!doctype x>') == ["a < b c d"]
    assert texts("<p>one<p>two<li>three<li>four<td>five<td>six</p>") == ["one", "two", "three", "four", "five", "six"]
    assert texts("x<script>if (a<b) </scrip> </SCRIPT >y<style>q") == ["xy"]
    assert texts("&lt;b&gt; &eacute;&#8364;&nbsp; z &bogus; &amp;amp;") == ["<b> é€ z &bogus; &amp;"]
    assert texts("a<button>no</button>b<select><option>c</select>d<button>e") == ["abde"]
    assert texts("") == [] == texts("<") [1:] and texts("x<b") == ["x"] and texts("x<!-- y") == ["x"] and texts("x</>y<?z?>w") == ["xyw"]
    assert texts("<a ='><p>x") == ["x"] and texts("<a b='>x'>y") == ["y"]


@pytest.mark.parametrize("part", ["<", "<a ", '<a href="', "<!--", "<div>", "<p>", "</div>", "<script>", "<button>", '<a href="x" ', "<table><td><p>", "<li>x", "<a ='", "<ul><li>x", "&amp;", "x<h1>"])
def test_broken_pages_take_linear_time(part):
    started = time.monotonic()
    main_text.main_text(part * (600_000 // len(part)))
    assert time.monotonic() - started < 12


def test_edges(spark):
    pages = [(1, "u", None), (2, "u", ""), (None, None, "<p>Only one sentence is here, and it says so itself.</p>"), (1, "u", "<nav>menu</nav>"), (5, "u", "<p>" + "long text. " * 100_000)]
    df = spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, url string, html string, text string, n_blocks int")
    got = [tuple(r) for r in df.select("page_id", main_text.extract(df, df["html"]).alias("t")).select("page_id", "t.*").collect()]
    assert [(i, len(t), n, k) for i, t, n, k in got] == [(1, 0, 0, 0), (2, 0, 0, 0), (None, 49, 1, 1), (1, 0, 1, 0), (5, 1_099_999, 1, 1)]
    assert df.limit(0).select(main_text.extract(df, df["html"])).count() == 0


def test_query(spark):
    """On the given pages the main text is the article element, block by block."""
    sf = "/root/testdata/sf0.001"
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in QUERIES["op13_main_text"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        inside = re.sub("</?(p|h1)>", "\0", r.html[r.html.index("<article>") + 9 : r.html.index("</article>")])
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in inside.split("\0")]
        text = "\n".join(b for b in blocks if b)
        assert got[r.page_id] == (r.url, text, len(text))
