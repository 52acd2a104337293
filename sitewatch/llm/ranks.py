"""Gapless ranks of a whole table in a given order, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.llm.common import store

_IN_PART = (1 << 33) - 1  # the row's number in ``monotonically_increasing_id``


def ranked(df: DataFrame, order: list[Column], name: str, by: str | None = None) -> DataFrame:
    """``df`` with its rank from 0 as ``name``: over all, or within each value of ``by``.

    ``order`` begins with ``by``, and makes ties impossible or indifferent. Rows are dealt out by
    ranges of the order, sorted in each part and stored with their number there. What lies before
    a part, or before the part that a value of ``by`` begins in, is a sum over one row for each
    part and value.
    """
    place = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("__place", place)
    dealt = store(
        dealt.withColumn("__part", F.shiftright("__place", 33)).withColumn(
            "__place", F.col("__place").bitwiseAND(F.lit(_IN_PART))
        ),
        "ranks",
    )
    keys = ["__part", *([by] if by else [])]
    sums = dealt.groupBy(*keys).agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    over = Window.partitionBy(*([by] if by else [])).orderBy("__part")
    before = F.coalesce(
        F.sum("__n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    bases = sums.select(*keys, (before - F.col("__first")).alias("__base"))
    same = F.col("d.__part") == F.col("b.__part")
    if by:
        same &= F.col(f"d.{by}").eqNullSafe(F.col(f"b.{by}"))
    joined = dealt.alias("d").join(bases.alias("b"), same)
    return joined.select(
        *[F.col(f"d.`{c}`") for c in df.columns], (F.col("__place") + F.col("__base")).alias(name)
    )
