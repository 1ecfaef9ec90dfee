"""Main text: hand-made pages with every kind of boilerplate, whole tables by a plain rule, and odd rows."""

import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from finloom.llm import main_text
from finloom.llm.main_text import align, extract, parse

SF = "/root/testdata/sf0.01"


def plain(html):
    """The article of the tables' pages, which have no markup in it but paragraphs, bold and line breaks."""
    article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    texts = (" ".join(unescape(re.sub(r"<[^>]*>", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(text for text in texts if text)


def test_query_over_the_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = main_text.op10_main_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.text == plain(pages[r.page_id].html)
        assert r.n_chars == len(r.text)


FURNITURE = """<!doctype html><html><head><title>t</title><style>p{}</style><script>var a = "</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=x>Home</a></nav>
<div id="cookie-notice">We use cookies</div><div class="ad top">Buy</div><aside>More</aside><!-- <p>no</p> -->
%s
<section id=comments><article class="comment"><p>First! I am a reader with a very long comment, longer than all else
on this page, so that size alone would mislead anyone who looks for the main text of the page.</p></article></section>
<form><p>Mail</p><input><button>Go</button></form><footer>&copy; all</footer>"""


@pytest.mark.parametrize(("inner", "text"), [
    ("<article><h1>A &amp; B</h1><p>One\n  two<br>three &eacute;&#33;</p>tail</article>", "A & B\nOne two three é!\ntail"),
    ("<article><p>one<p>two <b>bold <i>x</b> y</i><div class='social-share'>f t</div>after</article>",
     "one\ntwo bold x y\nafter"),
    ("<main><div><p>one</p><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></div></main>", "one\na\nb\nc\nd"),
    ("<div class=content><p>one</p><p hidden>no</p><p>two</p></div>", "one\ntwo"),
    ("<article><p>a</p><aside>no</aside><form>no</form><noscript>no</noscript>b<blockquote>c</blockquote></article>",
     "a\nb\nc"),
    ("<article>x <span class=ad>no</span> y <a href='>'>z</a></article>", "x y z"),
    ("<article></article>", ""),
    ("<article>a < b &lt;p&gt; c &nbsp; d</article>", "a < b <p> c d"),
])
def test_one_page(inner, text):
    assert extract([FURNITURE % inner]) == [text]


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "with-comments", "search-result", "article-share"])
def test_a_name_takes_no_article_away(name):
    inner = "<div class='%s'><div class=ad>Buy</div><article><p>one</p><div class=related>no</div></article></div>" % name
    assert extract([FURNITURE % inner]) == ["one"]
    assert extract([f"<body><nav>Home</nav><div class='{name}'><p>one</p><p>two</p></div>"]) == ["one\ntwo"]


def test_template_of_a_host_without_an_article_element():
    def page(i):
        return f"<body><div>Daily News</div><div><p>{told(i)}</p><p>and ends {i * i}</p></div><div>Imprint</div>"

    def told(i):
        return f"Story {i} begins, " * 6 + "goes on"

    assert extract([page(i) for i in range(9)]) == [f"{told(i)}\nand ends {i * i}" for i in range(9)]
    assert extract([page(3)] * 9) == [f"Daily News\n{told(3)}\nand ends 9\nImprint"] * 9
    assert extract([page(i) for i in range(3)])[0].startswith("Daily News")


def test_template_beside_empty_short_and_other_pages():
    def page(i, story):
        return f"<body><div>Daily News</div><div><p>{story}</p><p>and ends {i * i}</p></div><div>Imprint</div>"

    told = [f"Story {i} begins, " * 6 + "goes on" for i in range(20)]
    told[3] = "Brief."
    pages = ["", *(page(i, story) for i, story in enumerate(told)), "plain", "<table><tr><td>other</table>"]
    wanted = ["", *(f"{story}\nand ends {i * i}" for i, story in enumerate(told)), "plain", "other"]
    assert extract(pages) == wanted
    assert extract(pages[::-1]) == wanted[::-1]


def test_copies_of_an_article_are_no_template():
    same = "<p>" + "the same long paragraph of all copies " * 5 + "</p>"
    pages = [f"<article><h1>Copy {i}</h1>{same}</article>" for i in range(12)]
    assert all(text.endswith("of all copies") for text in extract(pages))


def test_alignment_is_the_largest():
    a, b = parse("<p>1<div><p>2</div><p>3<ul><li>4</ul>"), parse("<div><p>2</div><p>3<p>x<ul><li>4<li>5</ul>")
    pairs = align(a, b)
    assert [pairs[id(n)].text() for n in main_text.below(a) if id(n) in pairs] == ["", "", "2", "3", "", "4"]


def test_odd_rows(spark):
    deep = "<div>" * 5000 + "<p>deep</p>" + "</div>" * 5000
    html = [None, "", "plain", "<p", "<<>>", deep, "<b>" * 5000 + "bold", "<article>" + "<p>x</p>" * 4000]
    rows = [(i, None if i % 2 else "not a url", h) for i, h in enumerate(html)] + [(1, None, ""), (1, None, "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn(
        "cell", F.lit("x"))
    found = {r.page_id: (r.text, r.n_chars) for r in main_text.main_texts(frame).collect()}
    assert main_text.main_texts(frame).count() == len(rows)
    assert found[0] == found[1] == ("", 0) and found[2] == ("plain", 5)
    assert found[5] == ("deep", 4) and found[6] == ("bold", 4) and found[7] == ("\n".join("x" * 4000), 7999)
    assert main_text.main_texts(frame.limit(0)).count() == 0


def test_hosts_are_dealt_into_cells(spark, monkeypatch):
    monkeypatch.setattr(main_text, "CELL", 4)
    rows = [(i, f"http://u@Host.example:80/{i}", f"<article><p>page {i}</article>") for i in range(40)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {(r.page_id, r.text) for r in main_text.main_texts(frame).collect()} == {(i, f"page {i}") for i in range(40)}
