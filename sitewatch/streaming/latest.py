"""The latest observation per page, kept up to date while the history grows.

The table is a folder for each bucket of pages. A batch of new observations is merged with the
buckets its pages are in; the others keep their files.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from sitewatch.operators.views import latest_scrape_history
from sitewatch.schemas import HISTORY
from sitewatch.session import materialise, remove
from sitewatch.sources.commits import create_row
from sitewatch.sources.tables import RUN_COMMITS, read_history

BUCKETS = 256

_STORED = StructType([*HISTORY, StructField("bucket", IntegerType())])


def create_latest(spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
    """An empty table; fails when there is one already."""
    spark.createDataFrame([], _STORED).write.partitionBy("bucket").parquet(f"{root}/data")
    create_row(spark, f"{root}/layout", 0, {"buckets": buckets})


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest observation of each page that was merged so far."""
    return spark.read.schema(_STORED).parquet(f"{root}/data").select(*HISTORY.names)


def _replace(spark: SparkSession, root: str) -> None:
    """Put the buckets of ``pending`` in place of those in the table, again if need be."""
    pending = spark.read.schema(_STORED).parquet(f"{root}/pending")
    writer = pending.repartition("bucket").write.partitionBy("bucket").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(f"{root}/data")
    remove(spark, f"{root}/pending")


def _is_written(spark: SparkSession, path: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def merge_latest(observations: DataFrame, root: str) -> None:
    """Merge observations into the table; merging them twice changes nothing.

    The buckets they touch are written aside as a whole before they replace the old ones, so
    what a failure leaves half replaced is replaced by the next merge. Observations are reduced
    to one row for each page before any is compared with the table.
    """
    spark = observations.sparkSession
    if _is_written(spark, f"{root}/pending"):
        _replace(spark, root)
    buckets = spark.read.schema("buckets int").json(f"{root}/layout").first()["buckets"]
    bucket = F.pmod(F.xxhash64("page_id"), F.lit(buckets)).cast("int").alias("bucket")
    more = materialise(latest_scrape_history(observations).select("*", bucket), "more")
    # At most as many numbers as the table has buckets.
    touched = [row["bucket"] for row in more.select("bucket").distinct().collect()]
    if not touched:
        return
    stored = spark.read.schema(_STORED).parquet(f"{root}/data").where(F.col("bucket").isin(touched))
    merged = latest_scrape_history(stored.unionByName(more)).select("*", bucket)
    merged.write.mode("overwrite").parquet(f"{root}/pending")
    _replace(spark, root)


def follow_history(
    runs: DataFrame, history_path: str, latest_root: str, checkpoint: str
) -> StreamingQuery:
    """Process all runs committed since the last start, then stop.

    ``runs`` is the stream of a history's commits, so a run that is half written is not seen.
    ``latest_root`` was made by ``create_latest``. A batch replayed after a failure, or all of
    them after the checkpoint was lost, leave the table as it is.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_latest(read_history(batch.sparkSession, history_path, batch), latest_root)

    return (
        runs.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def history_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """The committed runs of a history as a stream."""
    return spark.readStream.schema(RUN_COMMITS).options(**options).json(f"{path}/commits")
