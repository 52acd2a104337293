"""Breadth-first discovery of a site over its stored links.

Links and visited URLs are laid out once in buckets by the same hash, so a round joins both where
they are and only its own URLs move. A source with very many links is several shards, each in a
bucket of its own. Each bucket is a folder, too, so a round of few URLs reads only their folders.
Rounds that add few URLs are many, and add a file instead of a row of buckets.
"""

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sitewatch.functions.urls import (
    browser_url,
    canonical_url,
    is_sub_page,
    marker_path,
    page_id,
)
from sitewatch.session import intermediate_path, materialise, materialise_buckets

# A source with more links is split, and a round with more URLs is not broadcast.
SHARD_LINKS = 10_000
NARROW = 10_000


def _zone(buckets: int, *columns: str) -> Column:
    """The bucket that Spark writes a row of these bucket columns to."""
    return F.pmod(F.hash(*columns), F.lit(buckets)).alias("zone")


def store_links(
    links: DataFrame, buckets: int | None = None, shard_links: int = SHARD_LINKS
) -> tuple[DataFrame, int]:
    """Store links ``(src_url, dst_url)`` for the rounds of a crawl, with the number of buckets.

    There are as many buckets as the session has shuffle partitions. ``shard`` is 0 but for
    sources with more links than ``shard_links`` and than a bucket has on average: there are
    fewer of these than buckets, so they are broadcast.
    """
    spark = links.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = Observation()
    read = links.select("src_url", "dst_url").observe(counted, F.count(F.lit(1)).alias("n"))
    read = materialise(read, "all-links")
    size = max(shard_links, -(-counted.get["n"] // buckets))
    hot = read.groupBy("src_url").agg(F.ceil(F.count(F.lit(1)) / size).alias("shards"))
    shard = F.coalesce(F.pmod(F.xxhash64("dst_url"), F.col("shards")), F.lit(0)).cast("int")
    dealt = (
        read.join(F.broadcast(hot.where("shards > 1")), "src_url", "left")
        .select("src_url", shard.alias("shard"), "dst_url")
        .repartition(buckets, "src_url", "shard")
        .withColumn("zone", _zone(buckets, "src_url", "shard"))
    )
    return materialise_buckets(dealt, "links", buckets, "src_url", "shard", folder="zone"), buckets


def _shards(links: DataFrame) -> DataFrame:
    """The sources that are split, with the number of their shards; fewer than buckets."""
    split = links.where("shard > 0").groupBy("src_url")
    return split.agg((F.max("shard") + 1).alias("shards"))


def _targets(
    links: DataFrame, buckets: int, urls: DataFrame, shards: DataFrame | None, wide: bool
) -> DataFrame:
    """What the URLs link to, each once; ``shards`` is None if no source is split."""
    sources = urls.select(F.col("url").alias("src_url"), F.lit(0).alias("shard"))
    if shards is not None:
        of_url = sources.select("src_url").join(F.broadcast(shards), "src_url", "left")
        last = F.coalesce("shards", F.lit(1)).cast("int") - 1
        sources = of_url.select("src_url", F.explode(F.sequence(F.lit(0), last)).alias("shard"))
    if wide:
        found = links.join(sources.hint("shuffle_hash"), ["src_url", "shard"])
    else:
        # Filtered, as only then the planner looks into leaving out folders.
        sources = sources.withColumn("zone", _zone(buckets, "src_url", "shard")).where("zone >= 0")
        found = links.join(F.broadcast(sources), ["zone", "src_url", "shard"])
    return found.select(F.col("dst_url").alias("url")).distinct()


def _without(
    targets: DataFrame, few: DataFrame, many: DataFrame | None, buckets: int, wide: bool
) -> DataFrame:
    """The stored targets that are not visited; the URLs of wide rounds stay where they are.

    ``few`` has the URLs of the other rounds, ``many`` is None before any wide one.
    """
    if wide:
        fresh = targets
        if many is not None:
            known = many.select("url").join(targets.hint("shuffle_hash"), "url", "left_semi")
            fresh = targets.join(known.hint("shuffle_hash"), "url", "left_anti")
        return fresh.join(few.select("url"), "url", "left_anti")
    known = few.join(F.broadcast(targets), "url", "left_semi").select("url")
    if many is not None:
        placed = targets.withColumn("zone", _zone(buckets, "url")).where("zone >= 0")
        of_many = many.join(F.broadcast(placed), ["zone", "url"], "left_semi")
        known = known.union(of_many.select("url"))
    return targets.join(F.broadcast(known), "url", "left_anti")


def reach(links: DataFrame, buckets: int, start_url: str, narrow: int = NARROW) -> DataFrame:
    """All URLs reachable from the start, with their distance: ``(url, depth)``.

    ``links`` and ``buckets`` come from ``store_links``; URLs are canonical. One round takes the
    links of the last round's URLs, distinct, without those visited before, and appends what is
    left to the visited URLs. The distinct combines map-side, so a target every page links to
    costs one row per task. Up to ``narrow`` URLs, counted when they were written, are broadcast.
    """
    spark = links.sparkSession
    base = intermediate_path(spark, "visited")
    name = f"sitewatch_{uuid.uuid4().hex}"
    shards = materialise(_shards(links), "shards")
    shards = None if shards.isEmpty() else shards
    many = None

    def add(urls: DataFrame, depth: int, wide: bool) -> int:
        counted = Observation()
        urls = urls.select("url").observe(counted, F.count(F.lit(1)).alias("n"))
        if wide:
            writer = urls.select("url", F.lit(depth).alias("depth"), _zone(buckets, "url")).write
            writer = writer.mode("append").partitionBy("depth", "zone").bucketBy(buckets, "url")
            writer.option("path", f"{base}/many").saveAsTable(name, format="parquet")
        else:
            urls.write.parquet(f"{base}/few/depth={depth}")
        return counted.get["n"]

    def read(kind: str) -> DataFrame:
        # By paths, as what was added a moment ago is to be seen.
        return spark.read.schema("url string, depth int").parquet(f"{base}/{kind}").select("url", "depth")

    try:
        start = canonical_url(browser_url(F.lit(start_url)))
        depth, wide = 0, False
        found = add(spark.range(1).select(start.alias("url")), 0, wide)
        while found:
            # By its own path, so that the planner sees the size of this round alone.
            own = f"{base}/{'many' if wide else 'few'}/depth={depth}"
            last = spark.read.schema("url string").parquet(own).select("url")
            counted = Observation()
            targets = _targets(links, buckets, last, shards, found > narrow)
            targets = targets.observe(counted, F.count(F.lit(1)).alias("n"))
            if found > narrow:
                targets = materialise_buckets(targets, "targets", buckets, "url")
            else:
                targets = materialise(targets, "targets")
            depth, wide = depth + 1, counted.get["n"] > narrow
            found = add(_without(targets, read("few"), many, buckets, wide), depth, wide)
            many = spark.table(name) if wide else many
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return read("few").union(read("many")) if many is not None else read("few")


def emitted_pages(
    visited: DataFrame,
    links: DataFrame,
    run_ts: datetime | Column,
    require_outlink: bool = True,
) -> DataFrame:
    """The pages a crawl reports, ``(id, url, depth)``: sub-pages that were really loaded.

    A page counts as loaded when it shows at least one in-site link of its own;
    ``require_outlink=False`` reports every sub-page reached.
    """
    pages = visited.where(is_sub_page(F.col("url")))
    if require_outlink:
        loaded = links.select(F.col("src_url").alias("url")).distinct()
        pages = pages.join(loaded, "url", "left_semi")
    return pages.select(page_id(marker_path(F.col("url")), run_ts).alias("id"), "url", "depth")


def crawl_site(
    links: DataFrame,
    start_url: str,
    run_ts: datetime | Column,
    require_outlink: bool = True,
) -> DataFrame:
    """Discovery as a whole, from in-site links to reported pages."""
    stored, buckets = store_links(links)
    return emitted_pages(reach(stored, buckets, start_url), stored, run_ts, require_outlink)
