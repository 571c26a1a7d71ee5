import html
import re

import pyarrow.parquet as pq
import pytest
from conftest import SF01

from linewise.llm import queries
from linewise.llm.text_density import extract_text, main_text

P1 = "The first paragraph tells what happened on the way to the harbour that morning, in some detail."
P2 = "A second paragraph follows, with a few more words about the ships, the weather and the people there."
P3 = "The last one closes the story and leaves nothing open, which readers of such stories like very much."
BODY = f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>"
WANT = "\n\n".join([P1, P2, P3])
MENU = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>"


@pytest.mark.parametrize("page", [
    f"<html><body>{MENU}<article>{BODY}</article><footer>(c) us</footer></body></html>",
    f"<body>{MENU}<div id=content>{BODY}</div><div class='sidebar'><p>{P1}</p><p>{P2}</p></div></body>",
    f"<body><div class='cookie-notice'><p>We use cookies for many good and bad things, as you will see.</p></div>{BODY}",
    f"<div class=wrap><div class=main>{BODY}</div></div><section id='comments'><p>{P3}{P1}</p><p>{P2}</p></section>",
    f"<form action=/x><input name=q><button>Go</button></form>{BODY}<script>var a='<p>no</p>';</script>",
    f"<header><h1>My site</h1><a href=/>home</a></header><main>{BODY}</main><aside>{P1}</aside>",
    f"<article>{BODY}<div class='share social'><a href=a>x</a></div><ul><li><a href=1>Tag</a><li><a href=2>Tag</a></ul></article>",
    f"<article><!-- <p>hidden</p> --><p>{P1}<p><b>{P2}<br><p>{P3}</article><div class=ad>{P2}",
    f"<style>p{{}}</style><table><tr><td>{P1}<td>{P2}<tr><td>{P3}</table>",
    f"<article><p>{P1}</p><aside>{P3}</aside><p>{P2}</p><p hidden>{P1}</p><p>{P3}</p><div class=comment-list>{BODY}</div></article>",
    f"<article><section><p>{P1}</p><p>{P2}</p></section><section><p>{P3}</p></section></article>",
    f"<article>{BODY}</article><article class='comment'><p>{P1}</p></article>",
    f"<body class='has-sidebar'><div class=ad>{BODY.replace('<p>', '<h1></h1><p>', 1)}",  # an advert never closed
])
def test_article_without_the_rest(page):
    assert main_text(page) == WANT


def test_blocks_references_and_space():
    page = "<article><h1>A &amp; B</h1><p>x&nbsp; y\n<b>z</b><br>w &lt;p&gt; &#233;&copy</p><p> </p><ul><li>one<li>two</ul></article>"
    assert main_text(page) == "A & B\n\nx y z w <p> é©\n\none\n\ntwo"


def test_title_beside_the_way_and_header_in_article():
    assert main_text(f"<body><h1>Title</h1><div>{BODY}</div></body>") == "Title\n\n" + WANT
    page = f"<article><header><h1>Title</h1><p class=by>by me</p></header>{BODY}</article>"
    assert main_text(page) == "Title\n\n" + WANT


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("just text\n here", "just text here"), ("<nav>a</nav>", ""),
    ("<p>open <a href='x>y</p>", "open y"), ("<script>never closed <p>x</p>", ""), ("<p>a<!-- open", "a"),
    ("a < b", "a < b"), ("<p>1 <2</p>", "1 <2"), ("</p></div>x", "x"),
])
def test_odd_pages(page, want):
    assert main_text(page) == want


def test_long_and_deep_pages_end():
    assert len(main_text("<p>word " * 50_000)) == 50_000 * 4 + 49_999 * 2
    assert main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert main_text("<a href=\"" * 20_000) == ""
    assert main_text("<b" * 20_000) == ""
    assert main_text("<article>" + f"<p>{P1}</p>" * 3000).count(P1) == 3000


def test_operator_columns_and_repeats(spark):
    rows = [(1, "u", f"<article>{BODY}</article>", "x"), (1, "u", f"<article>{BODY}</article>", "x"),
            (None, None, None, "y"), (3, "w", "", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, tags string")
    got = extract_text(pages, keep=("page_id", "url", "tags"), batch_chars=10).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars, r.tags) for r in got) == [
        (0, "", 0, "y"), (1, WANT, len(WANT), "x"), (1, WANT, len(WANT), "x"), (3, "", 0, "z")]
    assert extract_text(pages.limit(0)).collect() == []
    with pytest.raises(ValueError):
        extract_text(pages.withColumnRenamed("tags", "text"), keep=("page_id", "text"))


def test_pages_hold_their_article(spark):
    """Brute force: the pages of the test tables mark their article, whose blocks are read by patterns here."""
    want = {}
    for r in pq.read_table(f"{SF01}/pages.parquet").to_pylist():
        page = r["html"]
        inner = page[page.index("<article>") + 9:page.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split("</?(?:p|h1)>", inner)]
        want[r["page_id"]] = (r["url"], "\n\n".join(b for b in blocks if b))
    got = queries.op13_text_density(spark, SF01).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)
