from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitewatch.functions.urls import (
    base_url,
    browser_url,
    canonical_url,
    is_sub_page,
    marker_path,
    page_id,
    site_prefix,
)
from tests.helpers import T1, rows

SITE = "https://s.org"


def evaluate(spark, values, *build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = df.select("i", *[b(F.col("v")).alias(f"c{n}") for n, b in enumerate(build)])
    return [tuple(row)[1:] for row in sorted(got.collect())]


def test_canonical_emitted_and_id(spark):
    cases = [
        ("/#!/", "/#!", False, None),
        ("/#!/a", "/#!/a", True, "a"),
        ("/#!/a/b//", "/#!/a/b", True, "a_b"),
        ("/#!/a_b", "/#!/a_b", True, "a_b"),
        ("/#!//a", "/#!//a", True, "a"),
        ("/#!/a/#!/b", "/#!/a/#!/b", True, "a"),
        ("/#!/#!/b", "/#!/#!/b", False, None),
        ("/#!//#!/b", "/#!//#!/b", True, "homepage"),
        ("/#!/A?x=1", "/#!/A?x=1", True, "A?x=1"),
        ("/#!/n/v/id::1770/t", "/#!/n/v/id::1770/t", True, "n_v_id::1770_t"),
    ]
    got = evaluate(
        spark,
        [SITE + url for url, *_ in cases],
        canonical_url,
        lambda u: is_sub_page(canonical_url(u)),
        lambda u: F.when(
            is_sub_page(canonical_url(u)), page_id(marker_path(canonical_url(u)), T1)
        ),
    )
    assert got == [(SITE + canonical, emitted, id_) for _, canonical, emitted, id_ in cases]


def test_id_of_a_path_that_is_not_there(spark):
    epoch = int(T1.timestamp())
    assert evaluate(spark, [None, "", "///"], lambda p: page_id(p, T1)) == [
        (f"unknown_{epoch}",),
        ("homepage",),
        ("homepage",),
    ]


def test_base_url(spark):
    urls = ["https://s.org:8443/#!/a", "HTTP://S.org", "https://u:p@s.org?x", "s.org/a", None]
    assert evaluate(spark, urls, base_url, site_prefix) == [
        ("https://s.org:8443", "https://s.org:8443/#!/"),
        ("http://S.org", "http://S.org/#!/"),
        ("https://u:p@s.org", "https://u:p@s.org/#!/"),
        (None, None),
        (None, None),
    ]


def test_browser_url(spark):
    links = ["/#!/a b ", "/#!/ação\n", "/#!/%C3%A7", '/#!/"<`>', "/#!/x?a=1&b=2", "/#!/😀"]
    assert [u for (u,) in evaluate(spark, [SITE + u for u in links], browser_url)] == [
        SITE + "/#!/a%20b",
        SITE + "/#!/a%C3%A7%C3%A3o",
        SITE + "/#!/%C3%A7",
        SITE + "/#!/%22%3C%60%3E",
        SITE + "/#!/x?a=1&b=2",
        SITE + "/#!/%F0%9F%98%80",
    ]


def twin_id(path):
    parts = path
    while parts.startswith("/"):
        parts = parts[1:]
    while parts.endswith("/"):
        parts = parts[:-1]
    return "_".join(parts.split("/")) or "homepage"


URLISH = st.text(alphabet="ab/#!_? \té", max_size=14)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(URLISH, min_size=30, max_size=60))
def test_string_rules_agree_with_plain_python(spark, texts):
    got = evaluate(
        spark,
        texts,
        canonical_url,
        lambda u: canonical_url(canonical_url(u)),
        marker_path,
        lambda u: page_id(u, T1),
        lambda u: browser_url(browser_url(u)) == browser_url(u),
    )
    for text, (canonical, again, path, id_, stable) in zip(texts, got):
        pieces = text.split("#!/")
        assert canonical == again == text.rstrip("/")
        assert path == (pieces[1] if len(pieces) > 1 else None)
        assert id_ == twin_id(text)
        assert stable


def test_rows_helper(spark):
    assert rows(spark.range(2)) == [(0,), (1,)]
