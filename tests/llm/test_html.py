from __future__ import annotations

from monthmill.llm import html_text as h

ARTICLE = "<article><h1>Head &amp; line</h1><p>First <b>bo</b>ld.<br><p>Second&nbsp;one</article>"
FURNITURE = '<nav><a href="/">home</a></nav><div class="cookie-notice">We use cookies</div>'


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_blocks_and_references():
    found = h.blocks("<body><p>a &lt;b&gt; &#233;<i>c</i> d\n\t e<p>f<li>g<script>if (a<b) x='</p>';</script><!-- <p>no</p> -->h")
    assert [b[1] for b in found] == ["a <b> éc d e", "f", "gh"]


def test_unclosed_markup():
    assert h.main_text(h.blocks("<body><article><p>one <b>two<p>three <a href='x"), []) == "one two three <a href='x"
    assert h.main_text(h.blocks("only text"), []) == "only text"
    assert h.main_text(h.blocks("<title>t</title><p>x<textarea>never closed <p>y"), []) == "x"


def test_main_text_without_furniture(spark):
    html = f"<html><body>{FURNITURE}{ARTICLE}<section id='comments'><p>Nice post, thank you very much for it.</p></section><footer>(c)</footer>"
    got = h.main_texts(pages(spark, [(1, "http://a.example/x", html)])).collect()[0]
    assert got.text == "Head & line First bold. Second one" and got.n_chars == len(got.text) and got.url == "http://a.example/x"


def test_host_votes_overrule_a_page(spark):
    """A page on which an unmarked box is longer than the main text still gives what the host's other pages agree on."""
    page = lambda main, box: f"<body><div class='box7'><p>{box}</p></div><div class='post-12'><p>{main}</p><p>more</p></div>"
    rows = [(i, "https://b.example/" + str(i), page("the text of a page " * 9, "buy")) for i in range(6)]
    rows.append((9, "https://b.example/9", page("short", "a long box of many words that is not the page's text " * 3)))
    got = texts(h.main_texts(pages(spark, rows)))
    assert got[9] == "short more"
    alone = texts(h.main_texts(pages(spark, [(9, "https://c.example/9", rows[-1][2])])))
    assert alone[9].startswith("a long box")
    paths = {r.host: r.paths for r in h.host_paths(pages(spark, rows)).collect()}
    assert paths == {"b.example": ["/body/div.post-#", "/body/div.box#"]}


def test_odd_rows_and_empty(spark):
    rows = [(1, None, None), (2, "http://a.example", ""), (None, None, ARTICLE), (3, "no host", "<p>x"), (3, "no host", "<p>x"), (4, "http://a.example", "<nav>only</nav>"),
            (5, "http://a.example/long", "<article>" + "<p>word " * 50_000), (6, "HTTP://A.Example:80/q?", "< 5 & > 3 </p></div><p>&bogus; &amp"), (7, "u", "<div " * 3000 + "x")]
    docs = pages(spark, rows).selectExpr("*", "'own' AS host", "'own' AS paths", "'own' AS text")
    got = h.main_texts(docs).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == by[4].text == "" and by[1].n_chars == 0 and by[1].url is None
    assert by[None].text.startswith("Head & line") and by[3].text == "x"
    assert by[5].n_chars == 50_000 * 5 - 1 and by[6].text == "< 5 & > 3 &bogus; &"
    assert h.main_texts(pages(spark, [])).count() == 0
