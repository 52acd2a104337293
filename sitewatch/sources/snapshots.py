"""A mutable table as numbered Parquet snapshots.

A snapshot is written to a folder of its own, which a row of the ``commits`` table names; it counts
from the moment the row is there. Readers never see a half-written state, no folder is written
twice, and of two writers of one version the second fails.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitewatch.operators.quality import duplicate_keys
from sitewatch.sources.commits import create_row

_COMMIT = "version bigint, data string"


def create_table(spark: SparkSession, root: str, schema: StructType) -> None:
    """An empty table, version 0; fails when there is one already."""
    spark.createDataFrame([], schema).write.parquet(f"{root}/version=0")
    create_row(spark, f"{root}/commits", 0, {"version": 0, "data": "version=0"})


def _current(spark: SparkSession, root: str):
    commits = spark.read.schema(_COMMIT).json(f"{root}/commits")
    return commits.agg(F.max(F.struct("version", "data"))).first()[0]


def current_version(spark: SparkSession, root: str) -> int:
    return _current(spark, root)["version"]


def read_snapshot(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The table as last committed."""
    return spark.read.schema(schema).parquet(f"{root}/{_current(spark, root)['data']}")


def commit_snapshot(
    df: DataFrame, root: str, version: int, key: str | None = None, required: tuple[str, ...] = ()
) -> None:
    """Write and commit ``df``.

    With ``key``, a value that occurs twice or is NULL fails before the commit, and so does a
    NULL in a ``required`` column, and a version that another writer has committed.
    """
    spark = df.sparkSession
    data = f"version={version}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{data}")
    written = spark.read.schema(df.schema).parquet(f"{root}/{data}")
    columns = [*([key] if key else []), *required]
    if columns:
        missing = written.where(" OR ".join(f"`{c}` IS NULL" for c in columns))
        if not missing.isEmpty():
            raise ValueError(f"NULL in {columns} of version {version} of {root}")
    if key and not duplicate_keys(written, key).isEmpty():
        raise ValueError(f"{key} is not unique in version {version} of {root}")
    if not create_row(spark, f"{root}/commits", version, {"version": version, "data": data}):
        raise ValueError(f"version {version} of {root} is committed already")
