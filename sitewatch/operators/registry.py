"""The registry of pages: one row per id, changed only by the crawl's upsert."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatch.operators.newest import newest_per_key
from sitewatch.session import as_timestamp


def one_page_per_id(crawled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split crawled pages ``(id, url, depth)`` into the page kept per id and the others.

    Kept is the lowest ``(depth, url)``. The others are found by an anti-join on
    ``(id, url)``, which spreads evenly even when one id holds most of the URLs.
    """
    pages = crawled.groupBy("id", "url").agg(F.min("depth").alias("depth"))
    kept = newest_per_key(pages, ["id"], [F.col("depth").asc(), F.col("url").asc()])
    return kept, pages.join(kept.select("id", "url"), ["id", "url"], "left_anti")


def upsert_pages(
    registry: DataFrame, crawled: DataFrame, run_ts: datetime | Column
) -> DataFrame:
    """The registry after a crawl; ``crawled`` has one ``(id, url)`` per id.

    A new id is inserted as active. A known id only gets the new crawl time, its URL and
    flag stay. Pages the crawl did not see stay as they are.
    """
    r, c = registry.alias("r"), crawled.select("id", "url").alias("c")
    is_new, was_seen = F.col("r.id").isNull(), F.col("c.id").isNotNull()
    return r.join(c, F.col("r.id") == F.col("c.id"), "full_outer").select(
        F.coalesce("r.id", "c.id").alias("id"),
        F.when(is_new, F.col("c.url")).otherwise(F.col("r.url")).alias("url"),
        F.when(is_new, F.lit(True)).otherwise(F.col("r.is_active")).alias("is_active"),
        F.when(was_seen, as_timestamp(run_ts))
        .otherwise(F.col("r.last_crawled_at"))
        .alias("last_crawled_at"),
    )
