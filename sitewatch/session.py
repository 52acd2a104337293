"""Session settings and the shared folder that intermediate tables are written to."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}
# The folders, and names of tables, that the innermost scope of this thread removes.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)
_tables: ContextVar[list[str] | None] = ContextVar("tables", default=None)


def build_session(app_name: str = "sitewatch", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Joins with one side in small even partitions, as a crawl's, need not sort the other.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "128m")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, as named by ``spark.checkpoint.dir``.

    Only a session within one process may fall back to a temporary folder: on a cluster,
    a local one too, that would be local to one machine, so an unset folder is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="sitewatch-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/sitewatch/{label}-{uuid.uuid4().hex}"


def intermediate_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that the run under way removes at its end."""
    path = scratch_path(spark, label)
    if (paths := _scope.get()) is not None:
        paths.append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends at the files, so a lost executor costs no recomputation, and
    the planner knows the real size when it picks the next join.
    """
    path = intermediate_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_buckets(
    df: DataFrame, label: str, buckets: int, *columns: str, folder: str | None = None
) -> DataFrame:
    """As ``materialise``, laid out so that joins and groups on ``columns`` move only the other side.

    Each task writes its rows into the buckets they belong to, below a folder for each value of
    ``folder``, if there is one; nothing is shuffled here. The table is registered only for as
    long as Spark needs it: with folders, that is until the scope ends.
    """
    spark = df.sparkSession
    path = intermediate_path(spark, label)
    name = f"sitewatch_{uuid.uuid4().hex}"
    writer = df.write.partitionBy(folder) if folder else df.write
    writer.bucketBy(buckets, *columns).option("path", path).saveAsTable(name, format="parquet")
    laid_out = spark.table(name)
    if not folder:
        spark.sql(f"DROP TABLE {name}")
    elif (tables := _tables.get()) is not None:
        tables.append(name)
    return laid_out


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes what its thread materialises within it, once a run has committed or failed."""
    paths, tables = [], []
    before, tables_before = _scope.set(paths), _tables.set(tables)
    try:
        yield
    finally:
        _scope.reset(before)
        _tables.reset(tables_before)
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in paths:
            remove(spark, path)


@contextmanager
def kept_beyond_scope() -> Iterator[None]:
    """What is materialised within it outlives the scope around."""
    paths, tables = _scope.set(None), _tables.set(None)
    try:
        yield
    finally:
        _scope.reset(paths)
        _tables.reset(tables)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, wherever Spark's own file systems keep it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def as_timestamp(run_ts: datetime | Column) -> Column:
    """The run time as a column; a datetime has to say its time zone."""
    if isinstance(run_ts, Column):
        return run_ts
    if run_ts.tzinfo is None:
        raise ValueError("run_ts needs a time zone")
    return F.lit(run_ts)
