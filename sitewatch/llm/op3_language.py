"""Language ID by prediction by partial matching.

For each language a tree of byte contexts of up to ``ORDER`` bytes is counted over labelled
texts, then frozen (``contexts.py``). A text's language is the one whose tree gives it the
shortest code. The score is that language's share of the probability, one half to the power of
the code length, among all languages.

Training takes whole labelled texts, about ``PER_LANGUAGE`` of each language, picked by a hash of
``doc_id``: that documented bound keeps the trees, and what reaches the driver, the same size for
any corpus. Every document is scored, over its whole text.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0; ties go to the first
language by name; with nothing to learn from, all are ``und``; a NULL ``doc_id`` is scored, is
never learned from and has a NULL ``held_out``; repeated rows are scored each; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import own_columns, text_slices
from sitewatch.llm.contexts import ContextTrees, gram_counts

ORDER = 3
PER_LANGUAGE = 2000
UNKNOWN = "und"
_HAS_LETTER = r"\p{L}"


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def train(
    labelled: DataFrame, order: int = ORDER, per_language: int = PER_LANGUAGE
) -> ContextTrees | None:
    """The trees of all languages in ``labelled (doc_id, text, lang)``; None without any."""
    usable = labelled.where(
        F.col("lang").isNotNull()
        & F.col("doc_id").isNotNull()
        & F.coalesce(F.col("text").rlike(_HAS_LETTER), F.lit(False))
    )
    # One row for each language; a language's share is then a filter that needs no shuffle.
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    parts = 1 << 30
    limit = F.lit(0)
    for lang, n in sizes.items():
        share = min(parts, -(-per_language * parts // n))
        limit = F.when(F.col("lang") == lang, F.lit(share)).otherwise(limit)
    picked = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(parts)) < limit)
    counts = gram_counts(picked.select(F.col("lang").alias("class"), "text"), order)
    return ContextTrees(counts.toPandas(), order)


def predict(docs: DataFrame, trees: ContextTrees | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``bits_per_byte``; ``docs`` needs ``text``."""
    unknown = [
        F.lit(UNKNOWN).alias("lang_pred"),
        F.lit(0.0).alias("score"),
        F.lit(None).cast("double").alias("bits_per_byte"),
    ]
    docs = docs.select([c for c in docs.columns if c not in ("lang_pred", "score", "bits_per_byte")])
    if trees is None:
        return docs.select("*", *unknown)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def score(columns: Iterator[tuple[pa.Array]]) -> Iterator[pa.Array]:
        trees = shared.value
        for texts in columns:
            found: list[np.ndarray] = []
            sizes: list[np.ndarray] = []
            for _, _, data, offsets in text_slices(texts):
                found.append(trees.code_lengths(data, offsets))
                sizes.append(np.diff(offsets))
            bits = np.concatenate(found) if found else np.zeros((0, len(trees.classes)))
            size = np.concatenate(sizes) if sizes else np.zeros(0)
            best = bits.argmin(axis=1)
            least = bits.min(axis=1)
            share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            names = np.array(trees.classes, object)[best]
            yield pa.StructArray.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array(share, pa.float64()),
                    pa.array(least / np.maximum(size, 1), pa.float64()),
                ],
                names=["lang_pred", "score", "bits_per_byte"],
            )

    scored = F.arrow_udf(score, "lang_pred string, score double, bits_per_byte double")
    known = F.coalesce(F.col("text").rlike(_HAS_LETTER), F.lit(False))
    return (
        docs.withColumn("__found", scored("text"))
        .withColumn("__known", known)
        .select(
            *[F.col(f"`{c}`") for c in docs.columns],
            F.when(F.col("__known"), F.col("__found.lang_pred")).otherwise(unknown[0]).alias("lang_pred"),
            F.when(F.col("__known"), F.col("__found.score")).otherwise(unknown[1]).alias("score"),
            F.when(F.col("__known"), F.col("__found.bits_per_byte")).alias("bits_per_byte"),
        )
    )


def op3_language(spark, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned from three quarters of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = train(own_columns(docs, "doc_id", "text", "lang").where(~held_out()))
    return predict(own_columns(docs, "doc_id", "text"), trees).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )
