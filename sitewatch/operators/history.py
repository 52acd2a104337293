"""One observation per active page and run."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.functions.footer import observed_fields, with_raw_footer
from sitewatch.functions.urls import browser_url, canonical_url
from sitewatch.operators.newest import newest_per_key
from sitewatch.schemas import NOT_FOUND, OBSERVED_FIELDS
from sitewatch.session import as_timestamp, materialise


def extract_footers(fetches: DataFrame) -> DataFrame:
    """The four observed fields of every fetch; the page itself goes no further."""
    read = with_raw_footer(fetches)
    return read.select(
        *[F.col(c) for c in read.columns if c != "raw"], *observed_fields(F.col("raw"))
    )


def newest_footers(
    fetches: DataFrame, run_ts: datetime | Column, urls: DataFrame | None = None
) -> DataFrame:
    """The observed fields of each URL's newest fetch as of ``run_ts``; of ``urls`` only, if given.

    Which fetches are the newest follows from two narrow columns; pages are read again only
    for those, and only they are parsed. Fetches of one URL at the same time all are, as the
    fields decide between them; then only short rows are shuffled.
    """
    before = fetches.where(F.col("fetched_at") <= as_timestamp(run_ts)).select(
        canonical_url(browser_url(F.col("url"))).alias("fetch_url"), "fetched_at", "html"
    )
    newest = before.groupBy("fetch_url").agg(F.max("fetched_at").alias("fetched_at"))
    if urls is not None:
        newest = newest.join(urls.toDF("fetch_url").distinct(), "fetch_url", "left_semi")
    wanted = materialise(newest, "newest")
    known = extract_footers(before.join(wanted, ["fetch_url", "fetched_at"], "left_semi"))
    return newest_per_key(known, ["fetch_url"], [F.col(f).asc() for f in OBSERVED_FIELDS])


def _numbered(df: DataFrame, page_id: str) -> DataFrame:
    """``df`` with ``number``, from 0 in the order of a hash of the page id, then the id.

    Rows are sorted by ranges of that order and stored; a file's rows are numbered where they
    are, behind those of the files before it. One row for each file says how many these are:
    few enough to broadcast.
    """
    order = [F.substring(F.md5(F.coalesce(page_id, F.lit(""))), 1, 3), F.col(page_id)]
    stored = materialise(df.repartitionByRange(*order).sortWithinPartitions(*order), "numbered")
    known = stored.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    )
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    files = known.groupBy("__file").agg(F.count(F.lit(1)).alias("n"))
    files = files.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    number = (F.col("__before") + F.col("__row")).alias("number")
    return known.join(F.broadcast(files), "__file").select(*stored.columns, number)


def number_pages(active: DataFrame) -> DataFrame:
    """``active`` with ``number``: a run numbers its rows while they are ids and URLs only."""
    return _numbered(active.select("id", "url"), "id")


def observe_pages(
    active: DataFrame, fetches: DataFrame, run_ts: datetime | Column
) -> DataFrame:
    """One row per active page: its fields as of ``run_ts``, or four times the marker.

    Many ids may share one URL, which makes that URL's partition of the join a large one.
    The planner splits it, which it can only do when both sides come straight from a
    shuffle, so the footers are stored before. Nor are pages parsed again if it fails.
    The ``number`` of a page goes with it.
    """
    urls = active.select(canonical_url(browser_url(F.col("url"))).alias("url"))
    newest = materialise(newest_footers(fetches, run_ts, urls), "footers")
    return (
        active.withColumn("page_url", canonical_url(browser_url(F.col("url"))))
        .join(newest, F.col("page_url") == F.col("fetch_url"), "left")
        .select(
            F.col("id").alias("page_id"),
            as_timestamp(run_ts).alias("scrape_timestamp"),
            *[F.coalesce(F.col(f), F.lit(NOT_FOUND)).alias(f) for f in OBSERVED_FIELDS],
            *[c for c in active.columns if c == "number"],
        )
    )


def with_history_ids(batch: DataFrame, first_id: int) -> DataFrame:
    """Number a batch from ``first_id`` on, without gaps and repeatably: by its ``number``.

    Then no row moves. A batch that comes without numbers is put in order as a whole.
    """
    numbered = batch if "number" in batch.columns else _numbered(batch, "page_id")
    columns = [c for c in batch.columns if c != "number"]
    return numbered.select((F.lit(first_id) + F.col("number")).cast("bigint").alias("id"), *columns)
