import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitewatch.operators.quality import (
    duplicate_keys,
    failed_checks,
    null_rows,
    orphans,
    quality_report,
)
from sitewatch.schemas import HISTORY, PAGE_LIST, REGISTRY
from sitewatch.session import as_timestamp, materialise, scratch_path, scratch_scope, shared_dir
from sitewatch.sources import tables
from sitewatch.sources.commits import create_row
from sitewatch.sources.snapshots import (
    commit_snapshot,
    create_table,
    current_version,
    read_snapshot,
)
from sitewatch.sources.tables import (
    append_history,
    create_history,
    read_csv,
    read_fetches,
    read_history,
    read_runs,
    write_csv,
)
from tests.helpers import T0, T1, T2, rows


def test_page_list_keeps_text_ids(spark, tmp_path):
    (tmp_path / "pages.csv").write_text("id,url\n2022,https://s.org/#!/a/2022\nb,https://s.org/#!/b\n")
    assert rows(read_csv(spark, str(tmp_path / "pages.csv"))) == [
        ("2022", "https://s.org/#!/a/2022"),
        ("b", "https://s.org/#!/b"),
    ]


@pytest.mark.parametrize("text", ["id,url\na\n", "url,id\nu,a\n"])
def test_wrong_page_list_fails(spark, tmp_path, text):
    (tmp_path / "pages.csv").write_text(text)
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "pages.csv")).collect()


CELL = st.one_of(st.none(), st.text(alphabet='a, "\\\n\té\'{}', max_size=8))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(CELL, CELL), min_size=1, max_size=20))
def test_csv_gives_back_every_text(spark, cells):
    # A column with an index keeps rows of two NULLs apart from blank lines.
    schema = "n int, id string, url string"
    data = [(i, *pair) for i, pair in enumerate(cells)]
    path = scratch_path(spark, "csv")
    write_csv(spark.createDataFrame(data, schema), path)
    df = read_csv(spark, path, spark.createDataFrame([], schema).schema, multiline=True)
    assert rows(df) == sorted(data, key=repr)


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "registry")
    create_table(spark, root, PAGE_LIST)
    with pytest.raises(Exception):
        create_table(spark, root, PAGE_LIST)
    assert current_version(spark, root) == 0
    assert rows(read_snapshot(spark, root, PAGE_LIST)) == []
    one = spark.createDataFrame([("a", "u")], PAGE_LIST)
    commit_snapshot(one, root, 1)
    # A snapshot that was written and not committed does not count.
    one.union(one).write.parquet(f"{root}/version=2-other")
    assert rows(read_snapshot(spark, root, PAGE_LIST)) == [("a", "u")]
    commit_snapshot(read_snapshot(spark, root, PAGE_LIST).selectExpr("'b' id", "url"), root, 2)
    assert rows(read_snapshot(spark, root, PAGE_LIST)) == [("b", "u")]
    with pytest.raises(ValueError):
        commit_snapshot(one, root, 2)


def test_a_commit_with_bad_keys_fails(spark, tmp_path):
    root = str(tmp_path / "registry")
    create_table(spark, root, PAGE_LIST)
    for bad in ([("a", "u"), ("a", "v")], [(None, "u")], [("a", None)]):
        with pytest.raises(ValueError):
            commit_snapshot(
                spark.createDataFrame(bad, PAGE_LIST), root, 1, key="id", required=("url",)
            )
    assert current_version(spark, root) == 0
    commit_snapshot(spark.createDataFrame([("a", "u")], PAGE_LIST), root, 1, key="id")
    # Of two commits with one version, as of two writers, the second fails.
    assert not create_row(spark, f"{root}/commits", 1, {"version": 1, "data": "version=0"})
    with pytest.raises(ValueError):
        commit_snapshot(spark.createDataFrame([("b", "u")], PAGE_LIST), root, 1)
    assert rows(read_snapshot(spark, root, PAGE_LIST)) == [("a", "u")]


def test_instants_come_back_from_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    moment = T1.replace(microsecond=123456)
    registry = spark.createDataFrame([("a", "", None, moment), ("", "u", True, None)], REGISTRY)
    write_csv(registry, path)
    assert rows(read_csv(spark, path, REGISTRY)) == rows(registry)


def observations(spark, pages, time):
    return spark.createDataFrame(
        [(p, time, "d", "u", "r", "t") for p in pages],
        "page_id string, scrape_timestamp timestamp, modified_date string, updated_by string, "
        "responsible string, full_modified_text string",
    )


def test_history_append(spark, tmp_path):
    path = str(tmp_path / "history")
    pages = spark.createDataFrame([(p, "u", True, T0) for p in "abc"], REGISTRY)
    create_history(spark, path)
    with pytest.raises(Exception):
        create_history(spark, path)
    assert append_history(spark, path, observations(spark, [], T0), pages) == 0
    assert rows(read_history(spark, path)) == []
    assert append_history(spark, path, observations(spark, ["a", "b"], T1), pages) == 2
    assert append_history(spark, path, observations(spark, ["a", "b", "c"], T2), pages) == 3
    got = rows(read_history(spark, path), "id", "page_id", "scrape_timestamp")
    assert [r[0] for r in got] == [1, 2, 3, 4, 5]
    assert {r[1:] for r in got[:2]} == {("a", T1), ("b", T1)}
    assert {r[2] for r in got[2:]} == {T2}
    for bad in ([None], ["a", "unknown"]):
        with pytest.raises(ValueError):
            append_history(spark, path, observations(spark, bad, T2), pages)
    assert read_history(spark, path).count() == 5
    # A run that is half written is not there, and its ids are not used up.
    read_history(spark, path).write.parquet(f"{path}/data/run=broken")
    assert read_history(spark, path).count() == 5
    assert append_history(spark, path, observations(spark, ["a"], T2), pages) == 1
    assert max(r[0] for r in rows(read_history(spark, path), "id")) == 6
    assert [r[0] for r in rows(read_runs(spark, path), "last_id")] == [2, 5, 6]


def test_two_appends_at_once_have_different_ids(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "history")
    pages = spark.createDataFrame([(p, "u", True, T0) for p in "abcdefgh"], REGISTRY)
    create_history(spark, path)
    with ThreadPoolExecutor(4) as pool:
        runs = [observations(spark, "abcdefgh"[: k + 2], T1) for k in range(4)]
        assert list(pool.map(lambda r: append_history(spark, path, r, pages), runs)) == [2, 3, 4, 5]
    assert sorted(r.id for r in read_history(spark, path).collect()) == list(range(1, 15))

    # Another writer comes first between reading the last id and claiming the next ones.
    plain, before = tables.create_row, []

    def late(spark, folder, number, row):
        if folder.endswith("claims") and not before:
            before.append(row)
            append_history(spark, path, observations(spark, "a", T2), pages)
        return plain(spark, folder, number, row)

    monkeypatch.setattr(tables, "create_row", late)
    assert append_history(spark, path, observations(spark, "bc", T2), pages) == 2
    assert sorted(r.id for r in read_history(spark, path).collect()) == list(range(1, 18))


def test_ids_are_checked_before_the_commit(spark, tmp_path):
    path = str(tmp_path / "history")
    pages = spark.createDataFrame([(p, "u", True, T0) for p in "ab"], REGISTRY)
    create_history(spark, path)
    twice = observations(spark, "ab", T1).withColumn("number", F.lit(0))
    with pytest.raises(ValueError):
        append_history(spark, path, twice, pages)
    assert rows(read_history(spark, path)) == []


def test_a_text_like_the_mark_of_null_and_bounded_files(spark, tmp_path):
    data = [(i, t) for i, t in enumerate(["\\N", "\\\\N", None, "", "N", "x\\N", "\\N\n", "\\", "\\\\\\N"])]
    df = spark.createDataFrame(data, "n int, text string").coalesce(1)
    write_csv(df, str(tmp_path / "csv"), rows_per_file=2)
    assert rows(read_csv(spark, str(tmp_path / "csv"), df.schema, multiline=True)) == sorted(data, key=repr)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 5


def test_read_errors_are_raised(spark, tmp_path):
    with pytest.raises(Exception):
        read_fetches(spark, str(tmp_path / "nothing")).collect()
    with pytest.raises(Exception):
        read_snapshot(spark, str(tmp_path / "nothing"), REGISTRY)
    create_history(spark, str(tmp_path / "history"))
    pages = spark.createDataFrame([("a", "u", True, T0)], REGISTRY)
    append_history(spark, str(tmp_path / "history"), observations(spark, ["a"], T1), pages)
    (run,) = (tmp_path / "history" / "data").glob("run=*")
    (run / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        read_history(spark, str(tmp_path / "history")).collect()


def test_checks(spark):
    pages = spark.createDataFrame(
        [("a", "u", True, T0), ("a", "v", True, T0), (None, "w", True, T0), ("b", None, True, T0)],
        REGISTRY.simpleString(),
    )
    history = spark.createDataFrame(
        [(1, "a", T0), (1, "z", T0), (2, "z", None), (3, None, T0), (None, "b", T0)],
        "id bigint, page_id string, scrape_timestamp timestamp",
    )
    assert rows(quality_report(pages, history)) == [
        ("foreign_key", "scrape_history", "page_id", 2),
        ("not_null", "pages", "id", 1),
        ("not_null", "pages", "url", 1),
        ("not_null", "scrape_history", "id", 1),
        ("not_null", "scrape_history", "page_id", 1),
        ("not_null", "scrape_history", "scrape_timestamp", 1),
        ("unique", "pages", "id", 1),
        ("unique", "scrape_history", "id", 1),
    ]
    assert rows(duplicate_keys(pages, "id")) == [("a", 2)]
    assert rows(null_rows(pages, "url"), "id") == [("b",)]
    assert rows(orphans(history, pages)) == [("z", 2)]
    clean = spark.createDataFrame([("a", "u", True, T0)], REGISTRY)
    empty = spark.createDataFrame([], HISTORY)
    assert rows(failed_checks(quality_report(clean, empty))) == []


def test_a_run_leaves_nothing_behind(spark, tmp_path):
    with scratch_scope(spark):
        path = materialise(spark.range(3), "left").inputFiles()[0].rsplit("/", 1)[0]
        assert os.path.isdir(path.removeprefix("file:").replace("///", "/"))
    assert not os.path.exists(path.removeprefix("file:").replace("///", "/"))


def test_scopes_of_two_threads_are_apart(spark):
    def run(k):
        with scratch_scope(spark):
            kept = materialise(spark.range(k), "kept")
            return [materialise(kept, "more").count() for _ in range(3)]

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(run, range(8))) == [[k] * 3 for k in range(8)]


def test_session_rules(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    with pytest.raises(ValueError):
        as_timestamp(T0.replace(tzinfo=None))
