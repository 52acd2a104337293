import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from sitewatch.llm.queries import ORACLES, QUERIES
from tests.llm.edge import edge

SF_DIR = "/root/testdata/sf0.01"


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS FROM '{SF_DIR}/documents.parquet'")
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, result.select(*columns).collect())) == sorted(expected)


def test_pipeline(spark, tmp_path):
    """Each stage on what the one before has kept; every case of edge rows passes through."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    more = edge(spark).select(columns).withColumn("doc_id", F.col("doc_id") + 100_000)
    docs = docs.unionByName(more)
    (tmp_path / "in").mkdir()
    docs.write.parquet(str(tmp_path / "in/documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(tmp_path / "in/benchmark.parquet"))
    sizes, stage_docs = [], docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage_docs = stage(spark, stage_docs, str(tmp_path / "in"))
        if k < 4:
            assert stage_docs.columns == columns
        stage_docs.write.parquet(str(tmp_path / f"{k}"))
        stage_docs = spark.read.parquet(str(tmp_path / f"{k}"))
        sizes.append(stage_docs.count())
    assert docs.count() > sizes[0] > sizes[1] == sizes[2] > sizes[3]
    kept = spark.read.parquet(str(tmp_path / "3"))
    assert stage_docs.where("start = 0").count() == sizes[3]
    whole = corpus_pipeline.run(spark, str(tmp_path / "in"))
    plain = lambda df: sorted(map(repr, df.select("doc_id", "doc_tokens").distinct().collect()))
    assert plain(whole) == plain(stage_docs)
    assert kept.where("text IS NULL").count() == 0
