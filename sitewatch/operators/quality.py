"""Checks of the stored tables. Parquet enforces neither keys nor NOT NULL, so these do."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The declared checks.
NOT_NULL = {"pages": ["id", "url"], "scrape_history": ["id", "page_id", "scrape_timestamp"]}
UNIQUE = {"pages": ["id"], "scrape_history": ["id"]}


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULL is not a value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def orphans(history: DataFrame, pages: DataFrame) -> DataFrame:
    """``page_id`` values the registry does not know, with their rows; NULL is allowed.

    Both sides are reduced to one row per page before the anti-join, so neither a page with
    very many observations nor an id registered very often is a large group there.
    """
    counted = (
        history.where("page_id is not null")
        .groupBy("page_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = pages.select(F.col("id").alias("page_id")).distinct()
    return counted.join(known, "page_id", "left_anti")


def _not_null_report(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "failures").select(
        F.lit("not_null").alias("check_name"),
        F.lit(name).alias("table_name"),
        "column_name",
        "failures",
    )


def _count_report(check: str, name: str, column: str, failing: DataFrame, n) -> DataFrame:
    return failing.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(check).alias("check_name"),
        F.lit(name).alias("table_name"),
        F.lit(column).alias("column_name"),
        "failures",
    )


def quality_report(pages: DataFrame, history: DataFrame) -> DataFrame:
    """One row per declared check with its number of failures, 0 when it holds.

    ``unique`` counts values, ``not_null`` and ``foreign_key`` count rows. The NULL
    checks of a table share one scan.
    """
    tables = {"pages": pages, "scrape_history": history}
    parts = [_not_null_report(t, tables[t], columns) for t, columns in NOT_NULL.items()]
    for table, columns in UNIQUE.items():
        for column in columns:
            failing = duplicate_keys(tables[table], column)
            parts.append(_count_report("unique", table, column, failing, F.count(F.lit(1))))
    parts.append(
        _count_report(
            "foreign_key", "scrape_history", "page_id", orphans(history, pages), F.sum("n")
        )
    )
    return reduce(DataFrame.unionByName, parts)


def failed_checks(report: DataFrame) -> DataFrame:
    return report.where("failures > 0")
