import html
import html.entities
import re

from pyspark.sql import functions as F

from sitewatch.functions.anchors import unescape
from sitewatch.operators.links import in_site, page_links, site_links
from tests.helpers import T0, T1, T2, rows

SITE = "https://s.org"


def hrefs(spark, html):
    pages = spark.createDataFrame([(1, html)], "id int, html string")
    return [href for _, _, href in rows(page_links(pages, "id"))]


def test_quotes_case_and_other_attributes(spark):
    html = """
      <a href="/one">1</a> <A class=x HREF='/two'>2</A> <a href=/three>3</a>
      <a title="a > b" data-href="/no" href = "/four">4</a> <a\nhref="/five"/>
      <a class="x"href="/six">6</a> <a title=' href="/no" ' href="/seven">7</a>
      <b title='<a href="/no">'>x</b> <a rel=it's href="/eight">8</a> <a href=/ni"ne>9</a>
      <a title href=/ten/>10</a> <a x==">" href="/eleven">11</a>
      <abbr href="/no">x</abbr> <a name="top">none</a> <a href="">empty</a> <a href>bare</a>
    """
    assert hrefs(spark, html) == ["/one", "/two", "/three", "/four", "/five", "/six", "/seven",
        "/eight", '/ni"ne', "/ten/"]


def test_what_is_not_markup_has_no_links(spark):
    html = """
      <!-- <a href="/no1"> --><script>var a = '<a href="/no2">';</script>
      <STYLE>/* <a href="/no3"> */</STYLE><textarea><a href="/no4"></textarea>
      <a href="/yes">y</a><!-- never closed <a href="/no5">
    """
    assert hrefs(spark, html) == ["/yes"]


def test_a_tag_cut_off_by_the_end_is_dropped(spark):
    assert hrefs(spark, '<a href="/yes">y</a><a href="/no1" title="x') == ["/yes"]
    assert hrefs(spark, '<a href="/yes">y</a><a href="/no2>') == ["/yes"]


def test_links_keep_document_order_and_repeat(spark):
    pages = spark.createDataFrame([(1, '<a href="b"><a href=""><a href="a"><a href="b">')],
                                  "id int, html string")
    assert rows(page_links(pages, "id")) == [(1, 0, "b"), (1, 2, "a"), (1, 3, "b")]


def test_character_references(spark):
    texts = ["a&amp;b", "&#47;&#x2F;&#X2f;", "&ccedil;&atilde;", "&copy=1", "&nope; & &", "&#0;",
             "&#55296;", "&#x1F600;", "&amp;lt;"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [t for _, t in rows(df.select("i", unescape(F.col("t"))))] == [
        "a&b", "///", "çã", "&copy=1", "&nope; & &", "�", "�", "😀", "&lt;"]


def test_in_site_is_a_prefix_of_the_link_as_written(spark):
    links = ["https://s.org/#!/a", "/#!/a", "http://s.org/#!/a", "https://s.org/about",
             "https://s.org:8443/#!/a", " https://s.org/#!/a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(links)], "i int, href string")
    got = rows(df.select("i", in_site(F.col("href"), F.lit(SITE + "/#!/"))))
    assert [flag for _, flag in got] == [True, False, False, False, False, False]


def page(*paths):
    return "".join(f'<a href="{SITE}/#!/{path}">x</a>' for path in paths)


def test_site_links_come_from_the_newest_fetch_of_the_run(spark):
    fetches = spark.createDataFrame(
        [
            (SITE + "/#!/a/", page("old"), T0),
            (SITE + "/#!/a", page("b/", "ç", "b"), T1),
            (SITE + "/#!/a", page("later"), T2),
            (SITE + "/#!/gone", page("x"), T0),
            (SITE + "/#!/gone", "no links any more", T1),
        ],
        "url string, html string, fetched_at timestamp",
    )
    assert rows(site_links(fetches, SITE + "/#!/", T1)) == [
        (SITE + "/#!/a", 0, SITE + "/#!/b"),
        (SITE + "/#!/a", 1, SITE + "/#!/%C3%A7"),
        (SITE + "/#!/a", 2, SITE + "/#!/b"),
    ]


def test_references_are_those_of_html(spark):
    names = [f"&{n}" for n in html.entities.html5 if n.endswith(";")]
    numbers = [0, 1, 9, 10, 13, 31, 65, 127, *range(128, 160), 0xD7FF, 0xD800, 0xDFFF, 0xE000,
               0xFDD0, 0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFF, 0x110000, 10**30]
    texts = names + [f"x&#{z}{n};y" for n in numbers for z in ("", "0" * 30)]
    texts += [f"x&#{x}{n:X};y" for n in numbers for x in "xX"] + ["&#65 &#x41&amp;#65;", "&;&#;&#x;&"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = dict(map(tuple, df.select("i", unescape(F.col("t"))).collect()))
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]


def resolved(text):
    """``html.unescape``, but for names without a semicolon before a letter, a digit or ``=``."""
    names = sorted(html.entities.html5, key=len, reverse=True)

    def one(match):
        if match[0].startswith("&#"):
            return html.unescape(match[0])
        for name in names:
            if match[1].startswith(name):
                rest = match[1][len(name) :]
                after = (rest + match.string[match.end() :])[:1]
                if not name.endswith(";") and (after.isascii() and after.isalnum() or after == "="):
                    continue
                return html.entities.html5[name] + rest
        return match[0]

    return re.sub(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|([A-Za-z][A-Za-z0-9]*;?))", one, text)


def test_names_without_a_semicolon(spark):
    legacy = [n for n in html.entities.html5 if not n.endswith(";")]
    texts = [f"/x?&{n}{after}" for n in legacy for after in ("", "=", "1", "x", ";", "&y", " z", "/", "é")]
    texts += ["/x?a&copy", "&ccedil&atilde", "&notit;", "&not;in", "&notin;", "&nosuch", "&", "&&amp", "&amp&amp=", "x&lt"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = dict(map(tuple, df.select("i", unescape(F.col("t"))).collect()))
    assert [got[i] for i in range(len(texts))] == [resolved(t) for t in texts]
