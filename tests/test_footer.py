import random

import pytest

from pyspark.sql import functions as F

from sitewatch.functions.elements import element_with_id
from sitewatch.functions.footer import CONTAINER_ID, _RAW, _walk, with_raw_footer
from sitewatch.operators.history import extract_footers, observe_pages
from sitewatch.schemas import NOT_FOUND as NF
from tests.helpers import T0, T1, T2, T3, rows

DATE, USER, RESP = "data-atualizacao-pagina", "usuario-atualizacao-pagina", "responsavel-pagina"


def span(id_, text):
    return f'<span id="{id_}">{text}</span>'


def footer(*content, attributes=""):
    return f'<html><body><div id="idCorpoRodape" {attributes}>{"".join(content)}</div></body></html>'


CASES = {
    "no container": ("<p>text</p>" + span(DATE, "12/03/2025"), (NF, NF, NF, NF)),
    "container only": (footer("some text"), (NF, NF, NF, NF)),
    "blank fields": (
        footer("t", span(DATE, " "), span(USER, "&nbsp;"), span(RESP, "\t\n")),
        (NF, NF, NF, NF),
    ),
    "date only": (
        footer("Em ", span(DATE, "12/03/2025 14:05")),
        ("12/03/2025", NF, NF, "Em 12/03/2025 14:05"),
    ),
    "untrimmed date": (
        footer("Em", span(DATE, " 12/03/2025 14:05 ")),
        ("12/03/2025", NF, NF, "Em 12/03/2025 14:05"),
    ),
    "date without time": (footer(span(DATE, "12/03/2025")), ("12/03/2025", NF, NF, "12/03/2025")),
    "date before a hard blank": (
        footer(span(DATE, "12/03/2025&nbsp;14:05")),
        ("12/03/2025", NF, NF, "12/03/2025 14:05"),
    ),
    "responsible only": (footer("Resp: ", span(RESP, "Ana")), (NF, NF, "Ana", "Resp: Ana")),
    "field outside": (span(DATE, "12/03/2025") + footer("text"), (NF, NF, NF, NF)),
    "field after the container": (footer("text") + span(USER, "Ana"), (NF, NF, NF, NF)),
    "hidden container": (footer(span(USER, "Ana"), attributes="hidden"), (NF, NF, NF, NF)),
    "undisplayed container": (
        footer(span(USER, "Ana"), attributes='style="color:red; display : none"'),
        (NF, NF, NF, NF),
    ),
    "hidden ancestor": (f"<div hidden>{footer(span(USER, 'Ana'))}</div>", (NF, NF, NF, NF)),
    "hidden field": (
        footer("x ", f'<i style="display:none">{span(USER, "Ana")}</i>', span(RESP, "Bia")),
        (NF, NF, "Bia", "x Bia"),
    ),
    "first of two fields": (footer(span(USER, "Ana"), " ", span(USER, "Bia")), (NF, "Ana", NF, "Ana Bia")),
    "first of two containers": (footer("x") + footer(span(USER, "Ana")), (NF, NF, NF, NF)),
    "lines": (
        footer("<p>Em ", span(DATE, "1/2/2025 9:00"), "</p>\n<p>Por <b>", span(USER, "Ana\n Sá"), "</b><br>x</p>"),
        ("1/2/2025", "Ana Sá", NF, "Em 1/2/2025 9:00\nPor Ana Sá\nx"),
    ),
    "references": (
        footer(span(USER, "A&ccedil;&#227;o &amp; Cia")), (NF, "Ação & Cia", NF, "Ação & Cia")
    ),
    "unclosed inner tags": (footer("<p>Por ", span(USER, "Ana<b>"), "<p>fim"), (NF, "Ana", NF, "Por Ana\nfim")),
    "void tags": (footer("<img src=x><hr>", span(USER, "A<wbr>na")), (NF, "Ana", NF, "Ana")),
    "script inside": (footer("<script>var x='</div>'</script>", span(USER, "Ana")), (NF, "Ana", NF, "Ana")),
    "cells": (
        footer("<table><tr><td>Por</td><td>", span(USER, "Ana"), "</td></tr><tr><td>fim</table>"),
        (NF, "Ana", NF, "Por Ana\nfim"),
    ),
    "cut off": (f'<div id="idCorpoRodape">Por <span id={USER}>Ana', (NF, "Ana", NF, "Por Ana")),
    "stray end tags": (footer("</b></p>", span(USER, "Ana"), "</section>"), (NF, "Ana", NF, "Ana")),
    "less-than as text": (footer("1 < 2 <3 ", span(USER, "Ana")), (NF, "Ana", NF, "1 < 2 <3 Ana")),
    "sign in an attribute": (
        f'<p title="a > b <i hidden>">x{footer(span(USER, "Ana"))}', (NF, "Ana", NF, "Ana")
    ),
    "the marker as text": (footer(span(DATE, "Not Found"), span(USER, "Ana")), (NF, "Ana", NF, "Not FoundAna")),
    "id spelled with references": (
        f'<div id="idCorpo&#82;odape">{span(USER, "Ana")}</div>', (NF, "Ana", NF, "Ana")
    ),
    "id in other case": (f'<div id="idcorporodape">{span(USER, "Ana")}</div>', (NF, NF, NF, NF)),
    "empty page": ("", (NF, NF, NF, NF)),
    "no page": (None, (NF, NF, NF, NF)),
}


@pytest.fixture(scope="module")
def extracted(spark):
    pages = spark.createDataFrame([(n, h) for n, (h, _) in CASES.items()], "name string, html string")
    return {row[0]: tuple(row)[1:] for row in extract_footers(pages).collect()}


@pytest.mark.parametrize("name", CASES)
def test_extraction(name, extracted):
    assert extracted[name] == CASES[name][1]


def test_whole_long_page_is_read(spark):
    filler = "<p>" + "word " * 400_000 + "</p>"
    long = spark.createDataFrame([(filler + footer(span(USER, "Ana")),)], "html string")
    assert with_raw_footer(long).first().raw.updated_by == "Ana"


def test_one_observation_per_active_page(spark):
    def page(who):
        return footer(span(USER, who))

    fetches = spark.createDataFrame(
        [
            ("u/a", page("old"), T0),
            ("u/a/", page("new"), T1),
            ("u/a", page("later"), T3),
            ("u/b", page("later"), T3),
            ("u/x", page("not registered"), T0),
        ],
        "url string, html string, fetched_at timestamp",
    )
    active = spark.createDataFrame(
        [("a", "u/a"), ("a2", "u/a"), ("b", "u/b"), ("c", "u/c")], "id string, url string"
    )
    assert rows(observe_pages(active, fetches, T2)) == [
        ("a", T2, NF, "new", NF, "new"),
        ("a2", T2, NF, "new", NF, "new"),
        ("b", T2, NF, NF, NF, NF),
        ("c", T2, NF, NF, NF, NF),
    ]


PIECES = [
    "<div>", "</div>", "<p>", "</p>", "<br>", "text ", "a &amp; b", "<b hidden>", "</b>", "<b>",
    '<div id="idCorpoRodape">', "<i id='idCorpo&#82;odape'>", f'<span id="{DATE}">',
    f"<span id={USER}>", "</span>", "<!-- x > idCorpoRodape -->", "<!--", "-->", "<script>",
    "</script>", '<script>var x="</div>"</script>', '"', "'", '<p title="a > b',
    '<p title="idCorpoRodape" style="color:red">', '<i style="display:none">', "</i>", "<", ">",
    "=", "< 3", "idCorpoRodape", "<td>", "<title>x</title>", "<?x>", "<!DOCTYPE html>", "</>",
    '<a href=x"y>', "</a>",
]


def test_cutting_the_footer_out_changes_nothing(spark):
    chance = random.Random(3)
    pages = ["".join(chance.choices(PIECES, k=chance.randint(1, 25))) for _ in range(30_000)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").repartition(8)
    got = {r.i: tuple(r.raw) for r in with_raw_footer(df).collect()}
    found = 0
    for i, html in enumerate(pages):
        whole = _walk(html)
        expected = tuple(whole[name].text() if name in whole else None for name in _RAW)
        assert got[i] == expected, html
        found += expected[0] is not None
    assert found > 5_000


def test_the_part_sent_to_python_does_not_grow_with_the_page(spark):
    own = f'<div id="idCorpoRodape" class="x">{span(USER, "Ana")}<div>text</div></div>'
    around = [
        "{}", "<div>" + "<p>words <b>and</b> more</p>" * 20_000 + "{}</div>",
        "text " * 20_000 + "{}" + "<div>after</div>" * 20_000,
        '<div hidden><p id="a&amp;b">' + "x<br>" * 5_000 + "{}" + "y" * 100_000,
        "<style>#idCorpoRodape {}</style><!-- {} --><p title='{}'>" + "{}</p>",
    ]
    pages = [(i, own.join(a.rsplit("{}", 1))) for i, a in enumerate(around)] + [(5, "<p>none</p>"), (6, None)]
    df = spark.createDataFrame(pages, "i int, html string")
    parts = df.select("i", element_with_id(F.col("html"), CONTAINER_ID).alias("p")).orderBy("i").collect()
    assert [r.p and tuple(r.p) for r in parts] == [
        (own, False), (own, False), (own, False), (own, True), (own, False), None, None]
