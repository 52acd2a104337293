"""The two views over registry and history."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.operators.newest import newest_per_key

_HISTORY_COLUMNS = [
    "id",
    "page_id",
    "scrape_timestamp",
    "modified_date",
    "updated_by",
    "responsible",
    "full_modified_text",
]


def active_pages(registry: DataFrame) -> DataFrame:
    """``id`` and ``url`` of the active pages; a NULL flag is not active."""
    return registry.where("is_active = true").select("id", "url")


def latest_scrape_history(history: DataFrame) -> DataFrame:
    """The newest observation per page; equal times are decided by the higher id."""
    order = [F.col("scrape_timestamp").desc_nulls_first(), F.col("id").desc()]
    return newest_per_key(history.select(*_HISTORY_COLUMNS), ["page_id"], order)


def page_status(registry: DataFrame, latest: DataFrame) -> DataFrame:
    """Active pages with their latest observation, unordered.

    Pages never observed keep NULLs, pages observed without success keep the marker.
    """
    p, h = registry.alias("p"), latest.alias("h")
    return (
        p.where("p.is_active = true")
        .join(h, F.col("p.id") == F.col("h.page_id"), "left")
        .select(
            F.col("p.id").alias("page_id"),
            "p.url",
            "p.is_active",
            "p.last_crawled_at",
            F.col("h.scrape_timestamp").alias("last_scrape_timestamp"),
            F.col("h.modified_date").alias("last_modified_date"),
            F.col("h.updated_by").alias("last_updated_by"),
            F.col("h.responsible").alias("last_responsible"),
            F.col("h.full_modified_text").alias("last_full_modified_text"),
        )
    )


def page_current_status(registry: DataFrame, latest: DataFrame) -> DataFrame:
    """``page_status`` in reading order: newest first, never observed last, then by id."""
    return page_status(registry, latest).orderBy(
        F.col("last_scrape_timestamp").desc_nulls_last(), F.col("page_id").asc()
    )
