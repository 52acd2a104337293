"""From raw documents to packed training sequences: five stages, each an operator of ``sitewatch.llm``.

Every stage but the last returns the columns of ``documents``. Clean documents pass all of them
unchanged; a document of which repeated passages are removed goes on with the rest of its text.

Defined cases are those of the operators. Extra columns of ``documents`` go through all stages but
the last, whatever their names; a NULL ``doc_id`` is packed, and neither compared nor rejected for
what others hold; rows that share a ``doc_id`` are told apart by a hash of their texts; an empty
table stays one.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatch.llm import op1_repeats, op2_templates, op3_language, op8_minhash, op9_packing
from sitewatch.llm.common import own_columns, prepare, store
from sitewatch.session import kept_beyond_scope, scratch_scope

NEAR_WORDS = 5


def _aside(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, and all columns as one, so that none clashes with an operator's."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    return docs.select("doc_id", "text", row)


def _is_in(found: DataFrame) -> tuple[DataFrame, Column]:
    """``found (doc_id, text_key)`` for a join with ``_aside``, and the condition."""
    named = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    return named, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__key"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: not ``und``, and cheaper to code than raw bytes."""
    labelled = own_columns(docs, "doc_id", "text", "lang").where(~op3_language.held_out())
    trees = op3_language.train(labelled)
    found = op3_language.predict(_aside(docs), trees)
    usable = (F.col("lang_pred") != op3_language.UNKNOWN) & (F.col("bits_per_byte") < 8)
    return found.where(usable).select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by shingles of ``NEAR_WORDS`` words.

    It is the one of the smallest id; of rows that agree in id and text one stays, too.
    """
    groups = op8_minhash.near_duplicates(docs, words=NEAR_WORDS)
    left = _aside(docs).join(*_is_in(groups.where(~F.col("stays"))), "left_anti")
    first = groups.where("stays AND many").groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    repeated = store(first.where("n > 1"), "repeated")
    if repeated.isEmpty():  # then the documents are read, and joined, once
        return left.select("__row.*")
    again, same = _is_in(repeated)
    once = left.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(again, same, "left_anti").union(once).select("__row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occurred before; a text that had none is unchanged."""
    kept = op1_repeats.remove_repeats(_aside(docs))
    cut = F.col("n_removed") > 0
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text")}
    columns = []
    for field in docs.schema:
        own = F.col("__row").getField(field.name)
        if field.name in changed:
            own = F.when(cut, changed[field.name].cast(field.dataType)).otherwise(own)
        columns.append(own.alias(field.name))
    return kept.select(*columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaking = op2_templates.template_leaks(docs, items)
    return _aside(docs).join(*_is_in(leaking), "left_anti").select("__row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of 4096 ids, padded, with the pieces of documents each is made of.

    ``where("offset = 0").select("sequence_id", "n_ids", "ids")`` is what a training run reads.
    """
    return op9_packing.packed(docs)


def _shared(stage):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language ID", _shared(language_id)),
    ("MinHash near-dedup", _shared(near_duplicates)),
    ("substring dedup", _shared(substring_dedup)),
    ("benchmark decontamination", _shared(decontamination)),
    ("packing", _shared(packing)),
]

# Token ids and compressed models are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before it has written.

    What a stage keeps for itself is removed once its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark):
            result = stage(spark, docs, sf_dir)
            with kept_beyond_scope():
                docs = store(result, f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
