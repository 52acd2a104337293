"""Reports over registry and history: what changed, what is stale, how complete runs were."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.schemas import NOT_FOUND
from sitewatch.session import as_timestamp, materialise

_SHOWN = ["modified_date", "updated_by", "responsible"]

# How a Brazilian site writes a day.
DAY_FORMAT = "dd/MM/yyyy"


def with_modified_day(history: DataFrame, day_format: str = DAY_FORMAT) -> DataFrame:
    """``history`` with the date the page shows, as a date; NULL where it shows none.

    ``day_format`` is a Spark pattern: a site whose dates are written otherwise has its own.
    """
    return history.withColumn("modified_day", F.try_to_date("modified_date", day_format))


def change_events(history: DataFrame) -> DataFrame:
    """Observations whose shown fields differ from the page's observation before.

    The first observation of a page is no change. Each page is in order by time and id. Rows
    are dealt out by ranges of that order, so a page with most of them lies in many parts; what
    comes before the first row of a page in a part is the last row of the parts before, if it is
    that page's. One last row for each part is few enough to broadcast.
    """
    order = ["page_id", "scrape_timestamp", "id"]
    ranged = history.select(*order, *_SHOWN).repartitionByRange(*order)
    parts = materialise(ranged.withColumn("part", F.spark_partition_id()), "ranges")
    row = F.struct(*order, *_SHOWN)
    # By struct order, as the ranges are: NULL first.
    lasts = parts.groupBy("part").agg(F.max(row).alias("last"))
    last = F.lag("last").over(Window.orderBy("part")).alias("before_part")
    lasts = lasts.select("part", last)
    within = Window.partitionBy("part", "page_id").orderBy("scrape_timestamp", "id")
    found = parts.select("*", F.lag(row).over(within).alias("in_part")).join(F.broadcast(lasts), "part")
    of_page = F.when(F.col("before_part.page_id").eqNullSafe(F.col("page_id")), F.col("before_part"))
    found = found.withColumn("before", F.coalesce("in_part", of_page)).where("before IS NOT NULL")
    changed = F.lit(False)
    for c in _SHOWN:
        changed |= ~F.col(c).eqNullSafe(F.col(f"before.{c}"))
    previous = [F.col(f"before.{c}").alias(f"previous_{c}") for c in _SHOWN]
    return found.where(changed).select("id", "page_id", "scrape_timestamp", *_SHOWN, *previous)


def staleness(
    registry: DataFrame,
    latest: DataFrame,
    run_ts: datetime | Column,
    day_format: str = DAY_FORMAT,
) -> DataFrame:
    """Days since the date each active page shows, and since it was last observed."""
    day = F.to_date(as_timestamp(run_ts))
    shown = with_modified_day(latest, day_format).select("page_id", "modified_day", "scrape_timestamp")
    active = registry.where("is_active = true").select(F.col("id").alias("page_id"), "url")
    return active.join(shown, "page_id", "left").select(
        "page_id",
        "url",
        F.date_diff(day, "modified_day").alias("days_since_modified"),
        F.date_diff(day, F.to_date("scrape_timestamp")).alias("days_since_observed"),
    )


def pages_missed(registry: DataFrame) -> DataFrame:
    """Active pages the last crawl did not see, with the time of the last one that did."""
    last = registry.agg(F.max("last_crawled_at")).scalar()
    seen = F.col("last_crawled_at")
    missed = registry.where("is_active = true").where(seen.isNull() | (seen < last))
    return missed.select("id", "url", "last_crawled_at")


def coverage(history: DataFrame) -> DataFrame:
    """For each run, how many pages were observed and how many of them showed each field."""
    found = [F.count_if(F.col(c) != NOT_FOUND).alias(f"with_{c}") for c in _SHOWN]
    return history.groupBy("scrape_timestamp").agg(F.count("*").alias("pages"), *found)


def activity(history: DataFrame, day_format: str = DAY_FORMAT) -> DataFrame:
    """Observed updates by author and by the day the page shows."""
    shown = with_modified_day(history, day_format).where(F.col("updated_by") != NOT_FOUND)
    return shown.groupBy("updated_by", "modified_day").agg(
        F.count("*").alias("observations"), F.count_distinct("page_id").alias("pages")
    )


def section(url: Column) -> Column:
    """The first part of a URL's path, empty for a site's root."""
    return F.regexp_extract(url, r"^[a-z]+://[^/?#]+(?:/#!)?/*([^/?#]*)", 1)


def section_roll_up(registry: DataFrame, latest: DataFrame) -> DataFrame:
    """For each section of the site: pages, active ones, observed ones, last observation."""
    seen = latest.select(F.col("page_id").alias("id"), "scrape_timestamp")
    return (
        registry.select("id", section(F.col("url")).alias("section"), "is_active")
        .join(seen, "id", "left")
        .groupBy("section")
        .agg(
            F.count("*").alias("pages"),
            F.count_if("is_active").alias("active"),
            F.count("scrape_timestamp").alias("observed"),
            F.max("scrape_timestamp").alias("last_observed"),
        )
    )


def path_parts(url: Column) -> Column:
    """The parts of a URL's path, behind the marker if there is one; no empty ones."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]+(?:/#!)?/*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda part: part != "")


def prefix_roll_up(registry: DataFrame, latest: DataFrame) -> DataFrame:
    """The same for every prefix of the paths, every depth, and all pages.

    ``depth`` is the number of parts of ``prefix``; a page counts for each prefix of its path.
    Rows of a depth without a prefix are all pages that go that deep, the row without either is
    every page once. One pass of grouping sets, combined before the shuffle.
    """
    seen = latest.select(F.col("page_id").alias("id"), "scrape_timestamp")
    pages = registry.select("id", path_parts(F.col("url")).alias("parts"), "is_active")
    upto = F.explode(F.sequence(F.lit(0), F.size("parts"))).alias("depth")
    each = pages.join(seen, "id", "left").select("*", upto)
    each = each.withColumn("prefix", F.array_join(F.slice("parts", 1, F.col("depth")), "/"))
    whole = F.col("depth_of_page") == F.col("at")
    each = each.select(
        "depth", "prefix", "is_active", "scrape_timestamp",
        F.size("parts").alias("depth_of_page"), F.col("depth").alias("at"),
    )
    # The total takes each page at its whole path only.
    total = F.grouping_id() == 3
    pages_n = F.when(total, F.count_if(whole)).otherwise(F.count("*"))
    active = F.when(total, F.count_if(whole & F.col("is_active"))).otherwise(F.count_if("is_active"))
    is_seen = F.col("scrape_timestamp").isNotNull()
    observed = F.when(total, F.count_if(whole & is_seen)).otherwise(F.count_if(is_seen))
    sets = [[F.col("depth"), F.col("prefix")], [F.col("depth")], []]
    return each.groupingSets(sets, "depth", "prefix").agg(
        pages_n.alias("pages"),
        active.alias("active"),
        observed.alias("observed"),
        F.max("scrape_timestamp").alias("last_observed"),
    )
