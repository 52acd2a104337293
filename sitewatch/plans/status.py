"""Run C: the views a report reads, and the checks of the tables below them."""

from pyspark.sql import DataFrame, SparkSession

from sitewatch.operators.quality import quality_report
from sitewatch.operators.views import latest_scrape_history, page_current_status


def register_views(pages: DataFrame, history: DataFrame, prefix: str = "") -> dict[str, DataFrame]:
    """Make tables and views known to SQL by name; they are recomputed on every read."""
    latest = latest_scrape_history(history)
    views = {
        "pages": pages,
        "scrape_history": history,
        "vw_latest_scrape_history": latest,
        "vw_page_current_status": page_current_status(pages, latest),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(prefix + name)
    return views


def run_checks(spark: SparkSession, prefix: str = "") -> DataFrame:
    """The declared checks over the registered tables, one row each."""
    return quality_report(
        spark.table(f"{prefix}pages"), spark.table(f"{prefix}scrape_history")
    )
