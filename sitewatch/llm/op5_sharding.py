"""Sharding by proportional stratified interleaving.

Within each source rows are shuffled by a seeded hash and ranked; a row's fractional rank is
(rank + 1/2) / rows of its source. In the order of fractional ranks every stretch holds each source
in proportion, so the order is cut into shards whose sizes differ by one row at most: the law is
``rows``, and each shard has the mixture of the whole up to a row or so of each source.

Both ranks are taken over range partitions with prefix sums, so a source with a third of all rows
is spread over as many tasks as its share. Only narrow rows are sorted: no text is shuffled.

Equal texts need not share a shard under this law. Defined cases: a NULL source is a source of its
own; a NULL text has no byte, so size 1 and checksum 0; rows with equal ids, or NULL ones, are told
apart by their text's checksum and size, and where these agree, too, they are interchangeable; with
fewer rows than shards some shards are empty; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import own_columns, store
from sitewatch.llm.ranks import ranked

SHARDS = 16
SEED = 5


def shards(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, text_crc32, shard, slot`` of every row of ``docs``."""
    data = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    narrow = own_columns(docs, "doc_id", "source", "text").select(
        "doc_id",
        "source",
        (F.length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    # The first 60 bits of a digest: shuffled alike wherever it is computed.
    known = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("text_crc32").cast("string"), F.lit(str(seed)))
    mark = F.conv(F.substring(F.md5(known), 1, 15), 16, 10).cast("long")
    shuffled = narrow.withColumn("mark", mark)
    ties = [F.col(c) for c in ("mark", "doc_id", "text_crc32", "size")]
    within = ranked(shuffled, [F.col("source"), *ties], "rank", by="source")
    within = store(within, "op5-within")
    # One row for each source.
    sizes = within.groupBy("source").agg(F.count("*").alias("rows"))
    mixed = within.join(sizes, within["source"].eqNullSafe(sizes["source"])).drop(sizes["source"])
    # Twice the numerator, so that the fraction has no rounding of its own.
    fraction = (2 * F.col("rank") + 1) / F.col("rows")
    mixed = mixed.withColumn("fraction", fraction)
    placed = ranked(mixed, [F.col("fraction"), F.col("source"), *ties], "place")
    total = max(within.count(), 1)
    # Shard k holds the places from ceil(k * total / n) on.
    shard = F.expr(f"CAST(place * {n_shards} DIV {total} AS INT)")
    begins = F.expr(f"(shard * {total} + {n_shards - 1}) DIV {n_shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "source", "size", "text_crc32", "shard", (F.col("place") - begins).alias("slot")
    )


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    """The shard of every document and its place there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )
