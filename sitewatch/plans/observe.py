"""Run B: observe every active page and append the result to the history."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from sitewatch.operators.history import number_pages, observe_pages
from sitewatch.operators.views import active_pages
from sitewatch.schemas import REGISTRY
from sitewatch.session import scratch_scope
from sitewatch.sources.snapshots import read_snapshot
from sitewatch.sources.tables import append_history


def observe(
    spark: SparkSession,
    registry_root: str,
    fetches: DataFrame,
    history_path: str,
    run_ts: datetime,
) -> dict:
    """Append one row per active page, all with the time ``run_ts``; returns the counters."""
    with scratch_scope(spark):
        registry = read_snapshot(spark, registry_root, REGISTRY)
        batch = observe_pages(number_pages(active_pages(registry)), fetches, run_ts)
        saved = append_history(spark, history_path, batch, registry)
    return {"pages_loaded": saved, "rows_saved": saved}
