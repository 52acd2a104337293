"""The newest row per key, shared by the views and by every read of stored fetches."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which has to leave no ties.

    The rank filter makes the planner keep one row per key and input partition before
    the shuffle, so a key that holds a third of all rows sends one row per task. NULL
    keys form one group, as in SQL.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rn", rank).where("rn = 1").drop("rn")
