import html
import re

from pyspark.sql import functions as F

from slotcast.llm.html_text import blocks, content, extract

PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>More</a></ul></nav>
<div class="cookie-notice">We use cookies. Accept?</div>
<div id="content"><h2>Title&nbsp;here</h2><p>One &amp; two, fo<b>ur</b>.  Long
sentence &lt;with&gt; text, and more.<p>Second <a href="x>y">link</a> paragraph, it goes on.<!-- no -->
<ul><li>item one, first<li>item two, second</ul><div class="ad">Buy now!</div>
<script>var x = "</p>";</script></div>
<aside>x</aside><form>q<input></form><section id="comments"><p>Nice article, thanks a lot!</p></section>
<footer>&copy; 2020</footer></body></html>"""


def test_parts_of_a_page():
    assert content(PAGE) == (
        "Title here One & two, four. Long sentence <with> text, and more. "
        "Second link paragraph, it goes on. item one, first item two, second"
    )


def test_odd_pages():
    assert content("") == "" and content("<p>") == "" and content("plain text") == "plain text"
    assert content("<script>only") == "" and content("a < b and <i>c</i>") == "a < b and c"
    assert len(content("<p>ab " * 20000)) == 3 * 20000 - 1
    assert content("<div" * 3000) == "" and content('<a "' * 3000) is not None


def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*)</article>", r["html"], re.S).group(1)
        assert got[r["page_id"]] == " ".join(html.unescape(re.sub("<[^>]+>", " ", article)).split())


def test_ratios_decide_without_names(spark):
    """With every element that holds text a plain div or paragraph, and no classes."""
    exact = removed = 0
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in pages:
        article = re.search("<article>(.*)</article>", r["html"], re.S).group(1)
        bare = re.sub(r' class="[^"]*"', "", re.sub("<(/?)(article|nav|footer)>", r"<\1div>", r["html"]))
        text, found = content(bare), blocks(bare)
        exact += text == " ".join(html.unescape(re.sub("<[^>]+>", " ", article)).split())
        removed += len(text) < len(" ".join(b[1] for b in found))
        assert not any(named for _, _, _, named in found)
    assert exact >= 0.95 * len(pages) and removed >= 0.95 * len(pages)


def test_names_are_evidence_only():
    story = "<p>A sentence, with commas, of some length. And another one follows it.</p>" * 5
    assert content(f'<div class="widget">{story}</div><footer>Few words.</footer>').count("sentence") == 5
    deep = f"<div id=c>{story}<div><section><ul><li>short</ul></section></div></div><div>Buy it now!</div>"
    assert content(deep).endswith("short") and "Buy" not in content(deep)


def test_rows(spark):
    rows = [(1, None, None), (None, "u", "<p>x y</p>"), (2, "u", ""), (2, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    out = extract(df).collect()
    assert sorted((r["n_chars"], r["text"]) for r in out) == [(0, ""), (0, ""), (0, ""), (3, "x y")]
    assert extract(df.limit(0)).count() == 0
