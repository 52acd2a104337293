"""Explicit schemas of the stored tables; nothing is ever inferred."""

from pyspark.sql.types import (
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fixed value: what the history stores for a field that was looked for and not found.
# It is a different thing from NULL, which the status view shows for a page never observed.
NOT_FOUND = "Not Found"

PAGE_LIST = StructType(
    [
        StructField("id", StringType()),
        StructField("url", StringType()),
    ]
)

REGISTRY = StructType(
    [
        StructField("id", StringType(), nullable=False),
        StructField("url", StringType(), nullable=False),
        StructField("is_active", BooleanType()),
        StructField("last_crawled_at", TimestampType()),
    ]
)

HISTORY = StructType(
    [
        StructField("id", LongType(), nullable=False),
        StructField("page_id", StringType()),
        StructField("scrape_timestamp", TimestampType(), nullable=False),
        StructField("modified_date", StringType()),
        StructField("updated_by", StringType()),
        StructField("responsible", StringType()),
        StructField("full_modified_text", StringType()),
    ]
)

FETCHES = StructType(
    [
        StructField("url", StringType()),
        StructField("html", StringType()),
        StructField("fetched_at", TimestampType()),
    ]
)

# The four observed fields, in the order the history stores them.
OBSERVED_FIELDS = ["modified_date", "updated_by", "responsible", "full_modified_text"]
