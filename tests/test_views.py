from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sitewatch.operators.history import with_history_ids
from sitewatch.operators.views import active_pages, latest_scrape_history, page_current_status
from sitewatch.plans.status import register_views, run_checks
from sitewatch.schemas import HISTORY, REGISTRY
from sitewatch.schemas import NOT_FOUND as NF
from tests.helpers import T0, T1, T2, T3, rows


def observation(id_, page, time, who):
    return (id_, page, time, NF, who, NF, NF)


def history_of(spark):
    return spark.createDataFrame(
        [
            observation(1, "a", T1, "Ana"),
            observation(2, "a", T2, "Bia"),
            observation(3, "a", T2, "Cai"),
            observation(4, "b", T1, NF),
            observation(5, None, T1, "X"),
            observation(6, "x", T3, "Y"),
        ],
        HISTORY,
    )


def registry_of(spark):
    flags = {"c": True, "a": True, "b": True, "x": False, "n": None}
    return spark.createDataFrame([(id_, "u" + id_, flag, T0) for id_, flag in flags.items()], REGISTRY)


def test_latest(spark):
    latest = latest_scrape_history(history_of(spark))
    assert latest.columns == HISTORY.names
    assert sorted(row["id"] for row in latest.collect()) == [3, 4, 5, 6]


def test_active(spark):
    assert rows(active_pages(registry_of(spark))) == [("a", "ua"), ("b", "ub"), ("c", "uc")]


def test_status_in_order(spark):
    status = page_current_status(registry_of(spark), latest_scrape_history(history_of(spark)))
    got = [(r["page_id"], r["last_updated_by"], r["last_scrape_timestamp"] is None) for r in status.collect()]
    assert got == [("a", "Cai", False), ("b", NF, False), ("c", None, True)]


def test_views_by_name(spark):
    register_views(registry_of(spark), history_of(spark))
    assert spark.sql("SELECT page_id FROM vw_page_current_status").count() == 3
    assert spark.sql("SELECT * FROM vw_latest_scrape_history").columns == HISTORY.names
    failures = {(c, t, n): f for c, t, n, f in rows(run_checks(spark))}
    assert failures[("not_null", "scrape_history", "page_id")] == 1
    assert sum(failures.values()) == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([T0, T1, T2])),
                min_size=1, max_size=30))
def test_latest_has_one_row_per_page_with_its_newest_time(spark, seen):
    data = [observation(i, page, time, "w") for i, (page, time) in enumerate(seen)]
    got = rows(latest_scrape_history(spark.createDataFrame(data, HISTORY)),
               "page_id", "scrape_timestamp", "id")
    newest = {}
    for i, (page, time) in enumerate(seen):
        newest[page] = max(newest.get(page, (time, i)), (time, i))
    assert got == sorted(((p, t, i) for p, (t, i) in newest.items()), key=repr)


def test_ids_are_dense_and_repeatable(spark):
    pages = [f"page-{i}" for i in range(3000)]
    batch = spark.createDataFrame([(p,) for p in pages], "page_id string")
    numbered = rows(with_history_ids(batch.repartition(7), 101), "id", "page_id")
    assert sorted(n for n, _ in numbered) == list(range(101, 3101))
    assert numbered == rows(with_history_ids(batch.repartition(3), 101), "id", "page_id")
