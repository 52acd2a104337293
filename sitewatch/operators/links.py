"""Links of stored pages and the site graph they form."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatch.functions.anchors import anchor_tags, href_of
from sitewatch.functions.urls import browser_url, canonical_url, site_prefix
from sitewatch.operators.newest import newest_per_key
from sitewatch.session import as_timestamp, materialise


def page_links(pages: DataFrame, key: str) -> DataFrame:
    """Every non-empty link of every page: ``key``, ``position`` from 0, ``href`` as written."""
    return (
        pages.select(key, F.posexplode(anchor_tags(F.col("html"))).alias("position", "tag"))
        .select(key, "position", href_of(F.col("tag")).alias("href"))
        .where("href <> ''")
    )


def in_site(href: Column, start_url: Column) -> Column:
    """True when the link as written starts with the site's prefix; relative links do not."""
    return href.startswith(site_prefix(start_url))


def _may_be_written_as(url: Column, prefixes: list[str]) -> Column:
    """Whether a URL begins with one of the prefixes once a browser has tidied it.

    Only comparisons that a Parquet scan can use: blanks before the URL sort first, and a
    tab or line break, which a browser drops, may stand anywhere in the prefix.
    """
    fits = url < "!"
    for prefix in dict.fromkeys(prefixes):
        fits |= url.startswith(prefix)
        for k in range(1, len(prefix)):
            for dropped in "\t\n\r":
                fits |= url.startswith(prefix[:k] + dropped)
    return fits


def site_links(fetches: DataFrame, start_url: str, run_ts: datetime | Column) -> DataFrame:
    """In-site links ``(src_url, position, dst_url)`` of the newest fetch of each URL of the site.

    Only URLs of the site can be reached; the scan skips the others by their prefix where
    they are stored in some order. Which fetches are the newest follows from two narrow
    columns, and links are taken from those pages only, where they are read. Of fetches of
    one URL at one time the links decide. A page without links still takes part: it hides an
    older fetch that had some.
    """
    prefix = site_prefix(F.lit(start_url))
    hrefs = F.transform(anchor_tags(F.col("html")), href_of)
    targets = F.transform(
        F.filter(hrefs, lambda h: h.startswith(prefix)), lambda h: canonical_url(browser_url(h))
    )
    source = canonical_url(browser_url(F.col("url")))
    base = fetches.sparkSession.range(1).select(prefix).first()[0]
    of_site = _may_be_written_as(F.col("url"), [base.rstrip("/"), start_url.strip().rstrip("/")])
    before = fetches.where((F.col("fetched_at") <= as_timestamp(run_ts)) & of_site)
    newest = before.groupBy(source.alias("src_url")).agg(F.max("fetched_at").alias("fetched_at"))
    wanted = materialise(newest, "newest")
    per_fetch = (
        before.select(source.alias("src_url"), "fetched_at", "html")
        .join(wanted, ["src_url", "fetched_at"], "left_semi")
        .select("src_url", targets.alias("targets"))
    )
    return newest_per_key(per_fetch, ["src_url"], [F.col("targets").asc()]).select(
        "src_url", F.posexplode("targets").alias("position", "dst_url")
    )
