"""Main text: hand-made pages, and the given pages against their article element."""

import re
from html import unescape

import duckdb
import pytest

from siteloom.llm import htmltext, queries

MENU = '<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>'
CASES = [
    ("", ""),
    ("plain text", "plain text"),
    (f"<body>{MENU}<article><h1>T</h1><p>a &amp; b<br>c&nbsp;d</p></article><footer>f</footer></body>", "T\n\na & b c d"),
    ("<body><div class='post-12 content'><p>Real <b>text</b> here</p><div class=comments><p>no</p></div><form>no<input></form></div></body>", "Real text here"),
    ("<article><p>x < y &lt; &#x41;</p><script>if(a<b){'</article>'}</script><p hidden>no</p><!-- <p>no</p> --><pre> a\n  b </pre></article>", "x < y < A\n\na b"),
    ("<main><p>one<p>two<aside>no</aside><ul><li>three<li>four</ul></main>", "one\n\ntwo\n\nthree\n\nfour"),
    ("<div class='cookie-notice'>We use cookies and so on and on</div><main><p>Good text</p><div class=ad>Buy now</div></main>", "Good text"),
    ("<p>unclosed <b>bold <div>next", "unclosed bold\n\nnext"),
    ("<article><p>See this</p><figure><img src=x><figcaption>A caption</figcaption></figure><p>x is <math><mi>y</mi><annotation>TeX</annotation></math> here</p></article>", "See this\n\nA caption\n\nx is y here"),
    ("<article><p>Text</p><h2>References</h2><ul><li><a href=1>First source</a><li><a href=2>Second source</a></ul></article>", "Text\n\nReferences\n\nFirst source\n\nSecond source"),
    ("<div class=content><p>Before</p><p><a href=1>Link one</a></p><p><a href=2>Link two</a></p><p>After that</p></div>", "Before\n\nLink one\n\nLink two\n\nAfter that"),
    ("<article><div class='post-header'><h1>Title</h1></div><p class='share-price'>Up 3 %</p><div class='side-effects'><p>Few</p></div><h2 id='comments-on-war'>On war</h2><p>End</p></article>", "Title\n\nUp 3 %\n\nFew\n\nOn war\n\nEnd"),
    ("<article><p>Kept text</p><div class='comments-list'><p>no</p></div><div class='social-share'>no</div><div id='related-posts'><p>no</p></div><div class='ad-slot-3'>no</div><p class='copyright'>no</p></article>", "Kept text"),
    ("<div><p a='1>2'>quoted</p></div><!-- open <p>no", "quoted"),
]


@pytest.mark.parametrize("page, want", CASES)
def test_pages(page, want):
    assert htmltext.main_text(page, [p for p, _ in htmltext.votes(page)]) == want


def test_a_very_long_page_is_read_whole():
    body = "".join(f"<p>paragraph {i} of a long page</p>" for i in range(60_000))
    page = f"<body>{MENU}<article>{body}</article><footer>f</footer></body>"
    text = htmltext.main_text(page, [p for p, _ in htmltext.votes(page)])
    assert text.split("\n\n") == [f"paragraph {i} of a long page" for i in range(60_000)]


def test_hosts_vote(spark):
    """A page whose advert outweighs its article follows the other pages of its host."""
    good = "<body><div class=box><p>{0}</p></div><div class=deal><p>{1}</p></div></body>"
    rows = [(i, "http://h.org/1", good.format("article text " * 30, "buy"), "x") for i in range(9)]
    rows += [(9, "http://H.org/2", good.format("short", "buy this thing now " * 4), "x"), (10, None, None, "x"), (11, "http://z.org/", "", None), (9, "http://H.org/2", good.format("short", "buy this thing now " * 4), "x")]
    out = htmltext.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert len(out) == len(rows)
    assert {r.text for r in out if r.page_id == 9} == {"short"} and {r.text for r in out if r.page_id > 9} == {""}
    assert all(r.n_chars == len(r.text) for r in out)
    assert htmltext.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_minority_templates_keep_their_own_path(spark):
    """One page in ten of a host has another template: the path that both share is no answer for it."""
    menu = "<div class=deal><p>buy now</p></div>"
    main = "<html><body><main><article><p>{0}</p></article></main>" + menu + "</body></html>"
    post = "<html><body><div class=post><p>{0}</p></div>" + menu + "</body></html>"
    others = ["<html><body><div class=%s><p>{0}</p></div>%s</body></html>" % (c, menu) for c in ("alpha", "beta", "gamma", "delta", "eta")]
    body = "the article of this page " * 20
    rows = [(i, "http://h.org/", (post if i % 10 == 0 else main).format(f"{body}{i}")) for i in range(100)]
    rows += [(100 + i, "http://k.org/", others[i % 5].format(f"{body}{i + 100}")) for i in range(50)]
    out = htmltext.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {i: f"{body}{i}" for i in range(150)}


def test_many_hosts_are_joined_by_salt(spark, monkeypatch):
    rows = [(i, f"http://h{i % 5}.org/", f"<body><article><p>text {i}</p></article><div>menu</div></body>") for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    few = sorted(htmltext.extract(pages).collect())
    monkeypatch.setattr(htmltext, "narrow", lambda df, n: df)
    assert sorted(htmltext.extract(pages).collect()) == few
    assert [r.text for r in few] == [f"text {i}" for i in range(50)]


def test_given_pages(spark, sf_dir):
    pages = dict(duckdb.sql(f"select page_id, html from '{sf_dir}/pages.parquet'").fetchall())
    out = queries.QUERIES["op2_consensus_paths"](spark, sf_dir).collect()
    assert len(out) == len(pages)
    for r in out:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        pieces = (" ".join(unescape(re.sub("<br>", " ", re.sub("</?b>", "", p))).split()) for p in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n\n".join(p for p in pieces if p)
