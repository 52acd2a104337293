"""Page lists as CSV, fetches and history as Parquet. Read errors are raised, never hidden.

A history has its observations in ``data``, a folder for each run. A run first claims its ids, by
a row of ``claims`` that says where they begin and end, so two runs at once have different ones, as
from a sequence; a row of ``commits`` says that it is complete. Readers take the rows of committed
runs only, so a run is there as a whole or not at all; one that failed leaves a gap in the ids.
"""

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sitewatch.operators.history import with_history_ids
from sitewatch.operators.quality import orphans
from sitewatch.schemas import FETCHES, HISTORY, PAGE_LIST
from sitewatch.session import materialise
from sitewatch.sources.commits import create_row

_RUN = StructField("run", StringType())
_STORED_HISTORY = StructType([*HISTORY, _RUN])
RUN_COMMITS = "run string, committed_at timestamp, rows bigint, last_id bigint"

_CLAIMS = "number bigint, run string, first_id bigint, last_id bigint"

# What has to be said on both sides for every value to come back as it was. NULL is written
# as the mark, and a text that is backslashes and an N gets one more of them.
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\\N",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
CSV_ROWS = 100_000


def _texts(df: DataFrame, change) -> DataFrame:
    texts = {f.name: change(F.col(f"`{f.name}`")) for f in df.schema if f.dataType == StringType()}
    return df.withColumns(texts) if texts else df


def read_csv(
    spark: SparkSession, path: str, schema: StructType = PAGE_LIST, multiline: bool = False
) -> DataFrame:
    """A CSV table with a header; ids stay text and a malformed row fails the query.

    ``multiline`` is for texts with line breaks; such files cannot be split, see ``write_csv``.
    """

    def plain(text: Column) -> Column:
        return F.when(text.rlike(r"\A\\{2,}N\z"), F.substring(text, F.lit(2), F.length(text))).otherwise(text)

    read = (
        spark.read.schema(schema)
        .options(**_CSV, mode="FAILFAST", enforceSchema=False, multiLine=multiline)
        .csv(path)
    )
    return _texts(read, plain)


def write_csv(df: DataFrame, path: str, rows_per_file: int = CSV_ROWS) -> None:
    """``df`` as files of ``rows_per_file`` rows at most, as one file of texts with line breaks is
    one task when it is read."""

    def marked(text: Column) -> Column:
        return F.when(text.rlike(r"\A\\+N\z"), F.concat(F.lit("\\"), text)).otherwise(text)

    _texts(df, marked).write.options(**_CSV, maxRecordsPerFile=rows_per_file).csv(path)


def read_fetches(spark: SparkSession, path: str) -> DataFrame:
    """The stored pages, in place of a browser; queries read only the columns they use."""
    return spark.read.schema(FETCHES).parquet(path)


def create_history(spark: SparkSession, path: str) -> None:
    """An empty history; fails when there is one already."""
    empty = spark.createDataFrame([], _STORED_HISTORY)
    empty.write.partitionBy(_RUN.name).parquet(f"{path}/data")
    for name, schema in (("claims", _CLAIMS), ("commits", RUN_COMMITS)):
        spark.createDataFrame([], schema).write.json(f"{path}/{name}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row for each committed run."""
    return spark.read.schema(RUN_COMMITS).json(f"{path}/commits")


def read_history(spark: SparkSession, path: str, runs: DataFrame | None = None) -> DataFrame:
    """The observations of the committed runs, or of some of them.

    The runs, one short row each, are what prunes the folders of the data.
    """
    runs = read_runs(spark, path) if runs is None else runs
    stored = spark.read.schema(_STORED_HISTORY).parquet(f"{path}/data")
    return stored.join(runs.select(_RUN.name), _RUN.name, "left_semi").select(*HISTORY.names)


def _claim(spark: SparkSession, path: str, run: str, rows: int) -> dict:
    """The row that gives ``run`` the next ``rows`` ids; who comes second takes those behind."""
    while True:
        claims = spark.read.schema(_CLAIMS).json(f"{path}/claims")
        last = claims.agg(F.max("number").alias("number"), F.max("last_id").alias("last_id")).first()
        number, first = (last["number"] or 0) + 1, (last["last_id"] or 0) + 1
        claim = {"number": number, "run": run, "first_id": first, "last_id": first + rows - 1}
        if create_row(spark, f"{path}/claims", number, claim):
            return claim


def append_history(spark: SparkSession, path: str, batch: DataFrame, pages: DataFrame) -> int:
    """Append one run's observations and return their number; an empty run writes nothing.

    The batch is stored first: checking and numbering read it again, and the pages behind
    it should be parsed once. That write also counts the rows and the NULLs a history must
    not have; a page the registry does not know fails the whole run, too. Before the commit
    the ids that were written are checked to be those claimed, each once.
    """
    counted = Observation()
    stored = materialise(
        batch.observe(
            counted,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("page_id").isNull()).alias("no_page"),
            F.count_if(F.col("scrape_timestamp").isNull()).alias("no_time"),
        ),
        "batch",
    )
    seen = counted.get
    if seen["no_page"] or seen["no_time"]:
        raise ValueError(f"observations without page or time: {seen}")
    if not orphans(stored, pages).isEmpty():
        raise ValueError("observations of pages that are not registered")
    rows = seen["rows"]
    if rows:
        run = uuid.uuid4().hex
        claim = _claim(spark, path, run, rows)
        data = f"{path}/data/{_RUN.name}={run}"
        with_history_ids(stored, claim["first_id"]).write.parquet(data)
        ids = spark.read.schema(HISTORY).parquet(data).agg(F.min("id"), F.max("id"), F.count_distinct("id"))
        if tuple(ids.first()) != (claim["first_id"], claim["last_id"], rows):
            raise ValueError(f"ids of run {run} are not those it has claimed")
        now = datetime.now(timezone.utc).isoformat()
        commit = {"run": run, "committed_at": now, "rows": rows, "last_id": claim["last_id"]}
        create_row(spark, f"{path}/commits", claim["number"], commit)
    return rows
