from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sitewatch.operators.registry import one_page_per_id, upsert_pages
from sitewatch.schemas import REGISTRY
from tests.helpers import T0, T1, rows

CRAWLED = "id string, url string, depth int"


def test_upsert(spark):
    before = spark.createDataFrame(
        [("a", "u1", False, T0), ("b", "u2", True, T0), ("e", "u5", None, T0)], REGISTRY
    )
    crawled = spark.createDataFrame([("a", "CHANGED"), ("c", "u3"), ("e", "u5")], "id string, url string")
    expected = [
        ("a", "u1", False, T1),
        ("b", "u2", True, T0),
        ("c", "u3", True, T1),
        ("e", "u5", None, T1),
    ]
    after = upsert_pages(before, crawled, T1)
    assert rows(after) == expected
    assert rows(upsert_pages(after, crawled, T1)) == expected
    assert rows(upsert_pages(before, crawled.limit(0), T1)) == rows(before)
    assert rows(upsert_pages(before.limit(0), crawled, T1), "id", "is_active") == [
        ("a", True), ("c", True), ("e", True)]


def test_one_page_per_id(spark):
    crawled = spark.createDataFrame(
        [("a_b", "/a_b", 2), ("a_b", "/a/b", 2), ("a_b", "/0", 3), ("c", "/c", 1), ("c", "/c", 4)],
        CRAWLED,
    )
    kept, others = one_page_per_id(crawled)
    assert rows(kept) == [("a_b", "/a/b", 2), ("c", "/c", 1)]
    assert rows(others) == [("a_b", "/0", 3), ("a_b", "/a_b", 2)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("uvwxyz"), st.integers(0, 3)),
                min_size=1, max_size=40))
def test_no_page_is_lost(spark, pages):
    kept, others = one_page_per_id(spark.createDataFrame(pages, CRAWLED))
    assert sorted(r[0] for r in rows(kept)) == sorted({p[0] for p in pages})
    assert {r[:2] for r in rows(kept) + rows(others)} == {p[:2] for p in pages}
