"""Run A: find all pages of a site and bring the registry up to date."""

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sitewatch.operators.links import site_links
from sitewatch.operators.reach import crawl_site
from sitewatch.operators.registry import one_page_per_id, upsert_pages
from sitewatch.schemas import REGISTRY
from sitewatch.session import materialise, scratch_path, scratch_scope
from sitewatch.sources.snapshots import commit_snapshot, current_version, read_snapshot


def discover(
    spark: SparkSession,
    fetches: DataFrame,
    registry_root: str,
    start_url: str,
    run_ts: datetime,
    require_outlink: bool = True,
) -> dict:
    """Crawl the stored fetches from ``start_url`` and upsert what was found.

    Returns the counters of the run and, as ``collisions``, the path of the pages left
    out because another page has the same id. Without any page nothing is committed, and
    an id or URL that is missing, or an id that occurs twice, fails the run.
    """
    with scratch_scope(spark):
        counted = Observation()
        found = materialise(
            crawl_site(site_links(fetches, start_url, run_ts), start_url, run_ts, require_outlink)
            .observe(counted, F.count(F.lit(1)).alias("found")),
            "found",
        )
        result = {"pages_found": counted.get["found"], "pages_upserted": 0, "collisions": None}
        if not result["pages_found"]:
            return result

        kept, others = one_page_per_id(found)
        upserted = Observation()
        kept = kept.observe(upserted, F.count(F.lit(1)).alias("upserted"))
        kept = materialise(kept, "kept")
        result["pages_upserted"] = upserted.get["upserted"]
        if result["pages_upserted"] < result["pages_found"]:
            result["collisions"] = scratch_path(spark, "collisions")
            others.write.parquet(result["collisions"])

        registry = read_snapshot(spark, registry_root, REGISTRY)
        version = current_version(spark, registry_root) + 1
        after = upsert_pages(registry, kept, run_ts)
        commit_snapshot(after, registry_root, version, key="id", required=("url",))
        return result
