"""What has to hold of the physical plans for the data to be large and uneven."""

import contextlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sitewatch.operators.history import newest_footers, observe_pages
from sitewatch.operators.links import site_links
from sitewatch.operators.reach import _shards, _targets, _without, reach, store_links
from sitewatch.operators.reports import change_events
from sitewatch.operators.views import active_pages, latest_scrape_history, page_status
from sitewatch.schemas import FETCHES, HISTORY, REGISTRY
from sitewatch.session import materialise, materialise_buckets
from tests.helpers import T0, T1, plan_of, rows
from workload import stand_ins
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **conf):
    names = {name.replace("__", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# Sizes at which a test's few rows count as large and as skewed.
LARGE = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20000",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "40000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__shuffle__partitions": "8",
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("stored"))
    spark.createDataFrame([("a", "u", True, T0)], REGISTRY).write.parquet(f"{base}/pages")
    spark.createDataFrame([(1, "a", T0, "d", "u", "r", "t")], HISTORY).write.parquet(f"{base}/history")
    return (
        spark.read.schema(REGISTRY).parquet(f"{base}/pages"),
        spark.read.schema(HISTORY).parquet(f"{base}/history"),
    )


def test_active_flag_reaches_the_scan(stored):
    plan = plan_of(active_pages(stored[0]))
    assert "EqualTo(is_active,true)" in plan
    assert "struct<id:string,url:string,is_active:boolean>" in plan


def test_one_row_per_page_and_task_before_the_shuffle(stored):
    plan = plan_of(latest_scrape_history(stored[1]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert plan.count("Exchange") == 1


def test_only_used_columns_are_read(stored):
    status = page_status(stored[0], latest_scrape_history(stored[1]))
    plan = plan_of(status.select("page_id", "last_updated_by"))
    assert "full_modified_text" not in plan
    assert "struct<id:bigint,page_id:string,scrape_timestamp:timestamp,updated_by:string>" in plan


def test_status_join_reuses_the_partitioning_of_the_latest_rows(spark, stored):
    with settings(spark, **LARGE):
        plan = plan_of(page_status(stored[0], latest_scrape_history(stored[1])))
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", ["page_links", "site_links", "page_id_from_url", "registry_upsert",
                                  "page_current_status", "quality_report", "page_id_collisions"])
def test_no_python_but_for_the_footer(name, spark):
    assert "Python" not in plan_of(QUERIES[name](spark, SF_DIR))


def test_no_page_is_shuffled(spark):
    fetches = stand_ins.fetches(spark, SF_DIR)
    for plan in (
        plan_of(newest_footers(fetches, stand_ins.run_ts())),
        plan_of(QUERIES["site_links"](spark, SF_DIR)),
    ):
        moved = [line for line in plan.splitlines() if "Exchange" in line or "Sort [" in line]
        assert len(moved) >= 2 and not any("html" in line for line in moved)
        narrow = plan[: plan.rindex("Sort [")]
        assert "html#" not in narrow


def test_pages_are_parsed_once(spark):
    plan = plan_of(newest_footers(stand_ins.fetches(spark, SF_DIR), stand_ins.run_ts()))
    assert plan.count("ArrowEvalPython") == 1


def test_a_url_shared_by_most_pages_is_split(spark):
    active = spark.range(20_000).select(
        F.concat(F.lit("p"), "id").alias("id"),
        F.when(F.col("id") % 2 == 0, F.lit("u/hot")).otherwise(F.concat(F.lit("u/"), "id")).alias("url"),
    )
    fetches = spark.createDataFrame([("u/hot", "", T0), ("u/1", "", T0)], FETCHES)
    with settings(spark, **LARGE):
        batch = observe_pages(active.repartition(8), fetches, T1)
        assert len(batch.collect()) == 20_000
        assert "SortMergeJoin(skew=true)" in plan_of(batch)


def hot_links(spark):
    hot = spark.range(20_000).select(
        F.lit("hot").alias("src_url"), F.concat(F.lit("t"), "id").alias("dst_url"))
    others = spark.range(5_000).select(
        F.concat(F.lit("t"), "id").alias("src_url"), F.concat(F.lit("s"), "id").alias("dst_url"))
    return store_links(hot.union(others), 13, shard_links=1_000)


@pytest.mark.parametrize("narrow", [0, 6_000, 100_000])
def test_a_source_with_most_links_is_split(spark, narrow):
    links, buckets = hot_links(spark)
    with settings(spark, **LARGE):
        assert rows(reach(links, buckets, "hot", narrow).groupBy("depth").count()) == [
            (0, 1), (1, 20_000), (2, 5_000)]
    files = links.where("src_url = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 8 and max(r["count"] for r in files) < 6_000


def shuffled(plan):
    """What each shuffle of the plan that ran moves: the scans below it."""
    lines, found = plan[: plan.index("Initial Plan")].splitlines(), []
    indent = lambda line: len(line) - len(line.lstrip(" :+-"))
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = []
            for other in lines[k + 1 :]:
                if indent(other) <= indent(line):
                    break
                below.append(other)
            found.append("\n".join(below))
    return found


def test_a_wide_round_moves_neither_links_nor_visited_urls(spark):
    with settings(spark, spark__sql__shuffle__partitions="13"):
        links, buckets = hot_links(spark)
        visited = spark.range(30_000).select(F.concat(F.lit("s"), F.col("id") + 2_500).alias("url"))
        visited = materialise_buckets(visited, "visited", buckets, "url")
        last = materialise(spark.range(5_000).select(F.concat(F.lit("t"), "id").alias("url")), "last")
        shards = materialise(_shards(links), "shards")
        targets = _targets(links, buckets, last, shards, wide=True)
        assert len(targets.collect()) == 5_000
        plan = plan_of(targets)
        moved = shuffled(plan)
        assert "ShuffledHashJoin" in plan and "Bucketed: true" in plan
        # The round's URLs, and its targets after each task has made them distinct.
        assert [x for x in moved if "Scan" in x and "HashAggregate" not in x and "last-" not in x] == []
        assert len(moved) == 2
        stored = materialise_buckets(targets, "targets", buckets, "url")
        few = materialise(spark.createDataFrame([("s0",), ("x",)], "url string"), "few")
        fresh = _without(stored, few, visited, buckets, wide=True)
        assert len(fresh.collect()) == 2_499
        plan = plan_of(fresh)
        final = plan[: plan.index("Initial Plan")]
        assert "hashpartitioning" not in plan and final.count("Bucketed: true") == 3


def test_a_small_round_reads_only_its_buckets(spark):
    links, buckets = store_links(
        spark.range(400).select(
            F.concat(F.lit("n"), "id").alias("src_url"),
            F.concat(F.lit("n"), F.col("id") + 1).alias("dst_url")),
        4,
    )
    assert rows(reach(links, buckets, "n397")) == [
        ("n397", 0), ("n398", 1), ("n399", 2), ("n400", 3)]

    last = spark.createDataFrame([("n7",)], "url string")
    targets = _targets(links, buckets, last, _shards(links), wide=False)
    assert rows(targets) == [("n8",)]
    plan = plan_of(targets)
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    final = plan[: plan.index("Initial Plan")]
    assert not [x for x in shuffled(plan) if "Scan parquet" in x and "HashAggregate" not in x]
    assert final.count("BroadcastHashJoin") >= 1


def test_few_targets_do_not_shuffle_many_visited_urls(spark):
    visited = spark.range(50_000).selectExpr("concat('n', id) AS url")
    visited = visited.withColumn("zone", F.pmod(F.hash("url"), F.lit(7)))
    visited = materialise_buckets(visited, "visited", 7, "url", folder="zone")
    few = materialise(spark.createDataFrame([("n5",), ("new",)], "url string"), "few")
    before = materialise(spark.createDataFrame([("n9",)], "url string"), "before")
    fresh = _without(few, before, visited, 7, wide=False)
    assert rows(fresh) == [("new",)]
    plan = plan_of(fresh)
    semi = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert semi and all("BroadcastHashJoin" in line for line in semi)
    assert "dynamicpruning" in plan and "hashpartitioning" not in plan


def test_only_newest_fetches_are_parsed(spark, tmp_path):
    path = str(tmp_path / "fetches")
    stand_ins.fetches(spark, SF_DIR).withColumn("fetched_at", F.col("fetched_at").cast("timestamp")).select(
        *FETCHES.names
    ).write.parquet(path)
    fetches = spark.read.schema(FETCHES).parquet(path)
    footers = newest_footers(fetches, stand_ins.run_ts(), fetches.select("url"))
    assert footers.count() > 0
    plan = plan_of(footers)
    assert plan.index("ArrowEvalPython") < plan.index("LeftSemi")
    with settings(spark, spark__sql__maxMetadataStringLength="100000"):
        links = site_links(fetches, stand_ins.START_URL, stand_ins.run_ts())
        assert links.count() > 0
        plan = plan_of(links)
    pushed = plan[plan.index("PushedFilters") :]
    assert "StringStartsWith(url,https://site.example/#!)" in pushed and "LeftSemi" in plan


def test_a_page_with_most_observations_is_many_parts(spark):
    def seen(n, page):
        return spark.range(n).select(
            F.col("id"), page.alias("page_id"), F.timestamp_seconds(F.col("id") % 5_000).alias("scrape_timestamp"),
            (F.col("id") % 7).cast("string").alias("modified_date"), F.lit("u").alias("updated_by"),
            F.when(F.col("id") % 3 == 0, F.lit("r")).alias("responsible"), F.lit("t").alias("full_modified_text"))

    hot = seen(20_000, F.lit("hot"))
    others = seen(10_000, F.concat(F.lit("p"), F.col("id") % 40)).withColumn("id", F.col("id") + 50_000)
    nobody = seen(300, F.lit(None).cast("string")).withColumn("id", F.col("id") + 90_000)
    history = hot.union(others).union(nobody)
    with settings(spark, spark__sql__shuffle__partitions="16", spark__sql__adaptive__coalescePartitions__enabled="false"):
        got = rows(change_events(history))
        parts = materialise(history.select("page_id", "scrape_timestamp", "id").repartitionByRange(
            "page_id", "scrape_timestamp", "id").withColumn("part", F.spark_partition_id()), "parts")
        sizes = [r["count"] for r in parts.where("page_id = 'hot'").groupBy("part").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 4_000
    order = Window.partitionBy("page_id").orderBy("scrape_timestamp", "id")
    shown = ["modified_date", "updated_by", "responsible"]
    lagged = history.select("*", *[F.lag(c).over(order).alias(f"previous_{c}") for c in shown],
                            F.row_number().over(order).alias("n")).where("n > 1")
    differs = F.lit(False)
    for c in shown:
        differs |= ~F.col(c).eqNullSafe(F.col(f"previous_{c}"))
    columns = ["id", "page_id", "scrape_timestamp", *shown, *[f"previous_{c}" for c in shown]]
    assert got == rows(lagged.where(differs), *columns)
