"""Page elements, selectors and the fields, links and images found with them."""

import pytest

from newsweave.sources import pages as PG
from newsweave.sources.elements import Page, Selector


def pages(spark, *htmls):
    return spark.createDataFrame([(i, f"http://p/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")


def test_links_in_any_quoting(spark):
    df = pages(spark, """<a href='x'>1</a><A HREF="y">2</A><a class=k href="z&amp;q">3 <b>4</b></a><a name=n>no</a><a href="">no</a>""", None, "")
    got = [(r.idx, r.news_link, r.text) for r in PG.listing_links(df, container=None, link="a").orderBy("pos").collect()]
    assert got == [(0, "x", "1"), (1, "y", "2"), (2, "z&q", "34")]


def test_links_inside_containers_only(spark):
    box = 'div class="a section_article _TEMPLATE" data-template-id="SECTION_ARTICLE_LIST"'
    df = pages(spark, f"<a class=sa_text_title href=0></a><{box}><p><a class='sa_text_title b' href=1>t</a><p><a href=2></a></div><{box}><a class=sa_text_title href=3></a>")
    assert [r.news_link for r in PG.listing_links(df).orderBy("pos").collect()] == ["1", "3"]


def test_order_of_links_has_no_limit(spark):
    df = spark.createDataFrame([(1 << 62, "<a href=a></a>"), (5, "<a href=b></a><a href=c></a>")], "page_id long, html string")
    assert [r.news_link for r in PG.listing_links(df, None, "a").orderBy("pos").collect()] == ["b", "c", "a"]


@pytest.mark.parametrize("html,want", [
    ('<meta content="http://og" property="og:image">', "http://og"),
    ("<meta property='og:image' content='//og/x?a=1&amp;b=2'>", "https://og/x?a=1&b=2"),
    ('<img data-id="img1" src="http://wrong"><meta name="twitter:image" content="http://tw">', "http://tw"),
    ('<div id="img1"></div><img src="http://wrong">', None),
    ('<div id="img1"><span><img alt=""><img src="http://second"></span></div>', None),
    ('<div class=x id=img1><a><img data-lazysrc=http://lazy></a></div>', "http://lazy"),
    ('<img src="http://a" id="img1" data-src="http://b">', "http://a"),
    ('<img id="img1" src="" srcset="http://s 1x, http://t 2x , ">', "http://t"),
    ('<img id="img1" src="/rel"><meta property="og:image" content="http://og">', None),
    ('<meta property="og:image"><meta property="og:image" content="http://late">', None),
    ("", None), (None, None)])
def test_image_candidates(spark, html, want):
    assert PG.page_image(pages(spark, html)).first().image_url == want


def test_article_fields(spark):
    head = '<h2 class="media_end_head_headline">[a] T &amp; <i>u</i></h2>'
    logo = '<a class="media_end_head_top_logo"><img alt="P"></a>'
    time = '<span class="media_end_head_info_datestamp_time" data-date-time="2024-01-01 10:00:00">2024.01.01. 오전 10:00</span>'
    body = "<div class=_SUMMARY_CONTENT_BODY> <strong>s</strong> one<br> two <style>x</style></div>"
    df = pages(spark, head + logo + time + body, head + logo + time, head + logo, head + time, logo + time, None, head + '<a class="media_end_head_top_logo"><img></a>' + time)
    got = {r.pos: tuple(r)[:5] for r in PG.article_rows(df).collect()}
    when = ("2024.01.01. 오전 10:00", "2024-01-01 10:00:00")
    assert got == {0: ("T &u", "P", "s one two", *when), 1: ("T &u", "P", "", *when), 6: ("T &u", None, "", *when)}
    with pytest.raises(ValueError, match="html"):
        PG.page_fields(df.drop("html"))


def test_selectors():
    page = Page('<div id=a class="x y"><p>one<p>two <b data-k="v,w">b</b></div><ul><li>1<li>2<ul><li>3</ul><li>4</ul><p>three')
    found = {s: [page.text(e) for e in page.select(Selector(s))] for s in
             ("p", "div > p", "#a b", ".y.x p b", '[data-k="v,w"]', "b[data-k]", "ul > li", "ul ul li, #a b", "*.x > p > b", "ul p", "section")}
    assert found == {"p": ["one", "twob", "three"], "div > p": ["one", "twob"], "#a b": ["b"], ".y.x p b": ["b"], '[data-k="v,w"]': ["b"], "b[data-k]": ["b"],
                     "ul > li": ["1", "23", "3", "4"], "ul ul li, #a b": ["b", "3"], "*.x > p > b": ["b"], "ul p": [], "section": []}
    for bad in ("", "a >", "> a", "a:first-child", "a,,b"):
        with pytest.raises(ValueError):
            Selector(bad)
