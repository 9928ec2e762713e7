"""Pages marked up by hand, in styles that no layout generator here makes, with their expected text written out."""

import pytest

from placeweave.llm import pages

LEAD = "The harbour council met on Tuesday to settle the long dispute over the eastern breakwater and its repair."
MORE = "Members heard from the port engineer, who said that the stones laid in spring had already begun to move."
THIRD = "A second survey is due before winter, and the council asked that its findings be read out in full."

PAGES = {
    "plain divisions": (
        f"""<html><head><title>Harbour</title><style>p {{ x: y }}</style></head><body>
        <div id="nav"><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About</a></li></ul></div>
        <div id="content"><h1>Breakwater repair</h1><p>{LEAD}</p><p>{MORE}</p><p>{THIRD}</p></div>
        <div id="footer"><p>Copyright 2020 Harbour News. All rights reserved.</p></div></body></html>""",
        f"Breakwater repair\n{LEAD}\n{MORE}\n{THIRD}",
    ),
    "semantic elements, entities, comments by readers": (
        f"""<!doctype html><body><header><a href="#">Skip</a> <nav><a href="a">One</a> <a href="b">Two</a></nav></header>
        <main><article><h2>Caf&eacute; &amp; quay</h2><p>{LEAD}</p><script>var p = "<p>no</p>";</script>
        <blockquote><p>{MORE}</p></blockquote><ul><li>{THIRD}</li></ul></article>
        <section class="comments"><h3>Comments</h3><div class="comment"><p>I was there too, well written!</p></div></section></main>
        <aside class="sidebar"><h3>Related</h3><ul><li><a href="x">Other story</a></li></ul></aside>
        <footer>Contact us | Privacy</footer></body>""",
        f"Café & quay\n{LEAD}\n{MORE}\n{THIRD}",
    ),
    "article with an advert, a notice and a form between its paragraphs": (
        f"""<body><div class="cookie-notice">We use cookies. <button>Accept</button></div><div class="post"><div class="entry-content">
        <p>{LEAD}</p><div class="advert"><a href="z">Buy boats now, half price</a></div><p>{MORE}</p>
        <form action="s"><label>Subscribe</label><input name="e"><button>Go</button></form><p>{THIRD}</p></div></div>
        <div class="menu"><a href="1">Sport</a><a href="2">Weather</a><a href="3">Tides</a></div></body>""",
        f"{LEAD}\n{MORE}\n{THIRD}",
    ),
}


@pytest.fixture(scope="module")
def forest(spark):
    return pages.fit(spark)


@pytest.mark.parametrize("style", PAGES)
def test_pages_marked_up_by_hand(spark, forest, style):
    html, want = PAGES[style]
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert pages.extract_pages(df, forest).first()["text"] == want


def test_columns_that_clash_and_empty_tables(spark, forest):
    html = PAGES["plain divisions"][0]
    df = spark.createDataFrame([(1, "u", html, "old"), (1, "u", html, "old"), (None, None, None, "old")], "page_id long, url string, html string, text string")
    rows = pages.extract_pages(df, forest).collect()
    assert rows[0]["text"] == rows[1]["text"] != "old" and rows[2]["text"] == "" and rows[0]["url"] == "u"
    assert pages.extract_pages(df.limit(0), forest).count() == 0
