"""Pages as trees: quoting, comments, scripts, left-out end tags, selectors, table functions in SQL."""

import pytest
from pyspark.sql import functions as F

from newsloom.functions import markup as M
from newsloom.sources import readers as R

PAGE = """<!DOCTYPE html><html><body><!-- <a href="no"> --><script>var t="<a href='x'>";</script>
<ul class='big list'><li><a href='/one'>One <b>bold</b></a><li id=two data-k=v><A HREF=/two?x=1&amp;y=2>Two</A></ul>
<div id="d"><p>first<p>second <a href="/3">three</a></div><div><p>inner <span>a</span><span>b</span></p></div>
<table><tr><td>1<td>2<tr><td>3</table></p></nope><br/>tail <img src=i.png><a name=x>no address</a></body>"""

CASES = {
    "a[href]": ["One bold", "Two", "three"], "li": ["One bold", "Two"], "ul.list > li": ["One bold", "Two"], "#d p": ["first", "second three"], "div > p:first-child": ["first", "inner ab"],
    "p + p": ["second three"], "p ~ p": ["second three"], "td": ["1", "2", "3"], "tr": ["1 2", "3"], "td:nth-child(2)": ["2"], "a[href^='/t'], p:last-child": ["Two", "second three", "inner ab"],
    "li[data-k=v] a": ["Two"], "img": [""], "*.big > li:last-child": ["Two"], "[class~=list]": ["One bold Two"], "[src$='.png']": [""], "[src*=png]": [""], "p p": [], "script": ["var t=\"<a href='x'>\";"],
}


@pytest.mark.parametrize("css", CASES)
def test_selectors(css):
    got = list(M.select(PAGE, css))
    assert [x for *_, x in got] == CASES[css] and [s for s, *_ in got] == list(range(len(got)))


@pytest.mark.parametrize("css", ["", "a >", "a[", "::x", "> a"])
def test_unknown_selectors(css):
    with pytest.raises(ValueError):
        M.selector(css)


def test_odd_pages():
    assert list(M.select(None, "a")) == [] and list(M.select("", "a")) == []
    assert [a for _, _, a, _ in M.select('<a href=1 href="2" x>', "a")] == [{"href": "1", "x": ""}]
    assert [t for *_, t in M.select("<b>open <i>both</b> end", "b, i")] == ["open both", "both"]
    assert len(list(M.select("<div>x" * 3000, "div > div"))) == 2999
    assert [t for *_, t in M.select("<p>one<div>two</div>three", "p")] == ["one"]


def test_table_functions(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>none")], "page_id int, html string")
    assert set(M.register(spark)) == {"html_select", "html_links"}
    links = spark.sql("select p.page_id, l.* from {pages} p, lateral html_links(p.html) l", pages=pages).collect()
    assert [(r.page_id, r.seq, r.href, r.label) for r in links] == [(1, 0, "/one", "One bold"), (1, 1, "/two?x=1&y=2", "Two"), (1, 2, "/3", "three")]
    some = spark.sql("select p.page_id, s.tag, s.attrs['id'] as i, s.text from {pages} p, lateral html_select(p.html, 'li, p') s", pages=pages).collect()
    assert len(some) == 6 and (1, "li", "two", "Two") in [tuple(r) for r in some]
    assert [r.href for r in M.links(pages, "html").orderBy("seq").collect()] == ["/one", "/two?x=1&y=2", "/3"]
    with pytest.raises(ValueError):
        M.chosen(pages, "html", "a >")


def test_anchors_of_notices_however_quoted(spark):
    html = "<a href='/a1'>Road works</a><a href=/a2>Road closed</a><!-- <a href=\"/x\">Road gone</a> --><a href=\"/a3\">Tram &amp; road</a><a>Road none</a>"
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [r.link for r in R.notices(pages, "office", ["road"]).select("link").orderBy("link").collect()] == ["/a1", "/a2", "/a3"]
    assert R.page_anchors(pages).select(F.max("seq")).first()[0] == 2
