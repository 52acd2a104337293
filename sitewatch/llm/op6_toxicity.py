"""Toxicity by a classifier chain.

Categories are predicted one after the other. Each has a linear (logistic) model over a text's
features and over the log-odds that the models before it gave; in training those are out-of-fold
predictions, so a later model learns from earlier ones as good as they will be on new texts.

Features: whether a text has a word, a word beginning (4 to 6 bytes) or a run of 5 bytes within
a word. ``FEATURES`` of them are chosen by chi-square against each category. Presence, not
frequency, counts, so a short insult in a long text weighs as much as in a short one.

``labels`` has two marks. The chain in use is made of them: ``low_quality``, ``toxic``, and
``severe`` for both at once; any other 0/1 columns can be given. A text is toxic from the
probability on that parts labelled texts best in out-of-fold predictions, by an F score that
weighs precision twice, and at a half at least, so that clean texts are left alone.

Training takes ``SAMPLE`` labelled texts at most or so, half of them toxic if there are as many,
picked by a hash; the bound keeps the model, and what reaches the driver, the same size for any
corpus. What the draw changes in the share of a category is taken back from its model's constant,
and from the F score. Texts of equal features are in one fold. Every text is scored, and in full.

Defined cases: a NULL or empty text has no feature and is scored by the constant alone; a mark that
is NULL is left out of what it would train, a label without ``toxic`` out of all; of several marks of
one document the highest toxic and the lowest quality count; without labelled texts of both kinds
nothing is toxic; a NULL ``doc_id`` is scored; repeated rows are scored each; other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import Tokens, mix, own_columns, signed, store, text_slices

FEATURES = 384
SAMPLE = 8000
FOLDS = 5
RIDGE = 1.0
LEAST_TEXTS = 5
CHAIN = ("low_quality", "toxic", "severe")

_BEGINNINGS = (4, 5, 6)
_RUN = 5


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text number and the hash of every feature, repeats included."""
    tokens = Tokens(data, offsets)
    words = ~tokens.is_number
    starts, ends = tokens.starts[words], tokens.ends[words]
    text = np.repeat(np.arange(len(offsets) - 1), tokens.counts)[words]
    owners, hashes = [text], [tokens.hashes[words]]
    for n in _BEGINNINGS:
        long = ends - starts >= n
        owners.append(text[long])
        hashes.append(mix(tokens.hash_of(starts[long], starts[long] + n) + np.uint64(n)))
    runs = np.maximum(ends - starts - _RUN + 1, 0)
    first = np.repeat(starts - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
    owners.append(np.repeat(text, runs))
    hashes.append(mix(tokens.hash_of(first, first + _RUN) + np.uint64(101)))
    return np.concatenate(owners), np.concatenate(hashes)


class Lexicon:
    """Finds the chosen features among many hashes; most are ruled out by one small table."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self._maybe = np.zeros(1 << 16, bool)
        self._maybe[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def matrix(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which text has which feature."""
        owners, hashes = features(data, offsets)
        out = np.zeros((len(offsets) - 1, len(self.hashes)), np.float32)
        if not len(self.hashes):
            return out
        few = np.flatnonzero(self._maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[few]), len(self.hashes) - 1)
        hit = self.hashes[place] == hashes[few]
        out[owners[few[hit]], place[hit]] = 1
        return out


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -12, 12)))


def _fit(
    x: np.ndarray, y: np.ndarray, start: np.ndarray | None = None, ridge: float = RIDGE
) -> np.ndarray:
    """Weights of a logistic model; ``x`` ends with a column of ones.

    There is one best set of weights, wherever Newton's method starts; near it, it takes less.
    """
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1]) if start is None else start.copy()
    for _ in range(15):
        p = _sigmoid(x @ w)
        gradient = x.T @ (y - p) - penalty * w
        weight = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * weight[:, None]).T @ x + np.diag(penalty), gradient)
        w += step
        if np.abs(step).max() < 1e-3:
            break
    return w


class Chain(NamedTuple):
    categories: tuple[str, ...]
    lexicon: Lexicon
    weights: list[np.ndarray]

    def probabilities(self, known: np.ndarray) -> np.ndarray:
        """Each category's probability, from the matrix of features."""
        x = np.concatenate([known.astype(float), np.ones((len(known), 1))], axis=1)
        out = np.zeros((len(known), len(self.categories)))
        for k, w in enumerate(self.weights):
            out[:, k] = _sigmoid(x @ w)
            x = np.insert(x, -1, _logit(out[:, k]), axis=1)
        return out


def _counts(sample: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """How many texts have a feature, in all and of each category.

    Features of exactly the same texts, as the runs of one rare word, are one: the first by hash.
    """
    schema = "feature long, texts long, n long, " + ", ".join(f"`{c}` long" for c in categories)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                owners, hashes = features(data, offsets)
                order = np.lexsort((hashes, owners))
                owners, hashes = owners[order], hashes[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
                owners, hashes = owners[new], hashes[new]
                keys, first, where = np.unique(
                    hashes[np.argsort(hashes, kind="stable")], return_index=True, return_inverse=True
                )
                owners = owners[np.argsort(hashes, kind="stable")]
                prints = np.array(
                    [zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], np.uint64
                )
                prints = mix(prints + (np.diff(offsets).astype(np.uint64) << np.uint64(32)))
                texts = np.bitwise_xor.reduceat(prints[owners], first) if len(first) else prints[:0]
                columns = [
                    pa.array(signed(keys)),
                    pa.array(signed(texts)),
                    pa.array(np.bincount(where, minlength=len(keys))),
                ]
                for c in categories:
                    mark = batch.column(c).slice(lo, hi - lo).fill_null(0).to_numpy().astype(float)
                    sums = np.bincount(where, weights=mark[owners], minlength=len(keys))
                    columns.append(pa.array(sums.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, names=["feature", "texts", "n", *categories])

    counted = sample.mapInArrow(count, schema)
    sums = [F.sum(f"`{c}`").alias(c) for c in ("n", *categories)]
    counted = counted.groupBy("feature").agg(F.bit_xor("texts").alias("texts"), *sums)
    counted = counted.where(F.col("n") >= LEAST_TEXTS)
    firsts = [F.first(f"`{c}`").alias(c) for c in categories]
    return counted.groupBy("texts", "n").agg(F.min("feature").alias("feature"), *firsts)


def train(
    labelled: DataFrame,
    categories: tuple[str, ...],
    n_features: int = FEATURES,
    folds: int = FOLDS,
) -> tuple[Chain, pd.DataFrame] | None:
    """The chain, and the out-of-fold probabilities, of a bounded ``labelled (text, weight, ...)``.

    ``weight`` is how many labelled texts one of the sample stands for.
    """
    sums = labelled.agg(F.count("*").alias("n"), *[F.sum(f"`{c}`").alias(c) for c in categories]).first()
    total = sums["n"]
    if not total:
        return None
    counted = _counts(labelled, categories)
    chosen: set[int] = set()
    for c in categories:
        both, rest = F.col(f"`{c}`"), F.col("n") - F.col(f"`{c}`")
        marked, unmarked = sums[c], total - sums[c]
        if not marked or not unmarked:
            continue
        spread = both * (unmarked - rest) - rest * (marked - both)
        chi = spread * spread / (F.col("n") * (F.lit(total) - F.col("n") + 1))
        best = counted.orderBy(chi.desc(), "feature").limit(n_features // len(categories))
        chosen.update(r["feature"] for r in best.select("feature").collect())
    lexicon = Lexicon(np.array(sorted(chosen), np.int64).view(np.uint64))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                known = lexicon.matrix(data, offsets)
                bits = [row.tobytes() for row in np.packbits(known.astype(bool), axis=1)]
                marks = [batch.column(c).slice(lo, hi - lo) for c in categories]
                weight = batch.column("weight").slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bits, pa.binary()), weight, *marks],
                    names=["bits", "weight", *categories],
                )

    schema = "bits binary, weight double, " + ", ".join(f"`{c}` int" for c in categories)
    rows = labelled.mapInArrow(look_up, schema).toPandas()
    # The same order, whatever order the rows came in.
    rows = rows.sort_values(["bits", "weight", *categories], ignore_index=True)
    packed = np.frombuffer(b"".join(rows["bits"]), np.uint8).reshape(len(rows), -1)
    x = np.unpackbits(packed, axis=1, count=len(lexicon.hashes)).astype(float)
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    fold = np.array([zlib.crc32(b) % folds for b in rows["bits"]])
    drawn = rows["weight"].to_numpy(float)
    weights, unseen = [], {}
    for c in categories:
        y = rows[c].to_numpy(float)
        known = ~np.isnan(y)
        w = _fit(x[known], y[known])
        p = np.zeros(len(y))
        for k in range(folds):
            held = fold == k
            if held.any() and (known & ~held).any():
                p[held] = _sigmoid(x[held] @ _fit(x[known & ~held], y[known & ~held], w))
            else:
                p[held] = _sigmoid(x[held] @ w)
        shift = _shift(y[known], drawn[known])
        w[-1] += shift
        p = _sigmoid(_logit(p) + shift)
        weights.append(w)
        unseen[c] = p
        x = np.insert(x, -1, _logit(p), axis=1)
    out_of_fold = rows[[*categories, "weight"]].join(pd.DataFrame(unseen), rsuffix="_p")
    return Chain(tuple(categories), lexicon, weights), out_of_fold


def _shift(y: np.ndarray, weight: np.ndarray) -> float:
    """By how much the log-odds of a category differ between all labelled texts and the sample."""
    if not y.any() or y.all():
        return 0.0
    return float(_logit((weight * y).sum() / weight.sum()) - _logit(y.mean()))


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray, least: float = 0.5) -> float:
    """The probability with the best F0.5, between it and the next smaller one.

    ``least`` holds for odds as they are in the sample, where a rare category isn't rare.
    """
    if not y.any():
        return 1.1
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum((weight * y)[order])
    f = 1.25 * hits / (np.cumsum(weight[order]) + 0.25 * (weight * y).sum())
    last = np.append(p[order][1:] != p[order][:-1], True)
    at = int(np.argmax(np.where(last, f, -1)))
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    least = float(_sigmoid(_logit(np.array(least)) + _shift(y, weight)))
    return max(float((p[order][at] + below) / 2), least)


def score(docs: DataFrame, chain: Chain, threshold: float, target: str = "toxic") -> DataFrame:
    """``doc_id``, the probability of every category, and ``is_toxic``."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in chain.categories)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                p = chain.probabilities(chain.lexicon.matrix(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        *[pa.array(np.ascontiguousarray(column)) for column in p.T],
                    ],
                    names=["doc_id", *[f"p_{c}" for c in chain.categories]],
                )

    scored = own_columns(docs, "doc_id", "text").mapInArrow(predict, schema)
    return scored.withColumn("is_toxic", F.col(f"p_{target}") >= threshold)


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """About ``size`` labelled texts at most, with the categories of ``CHAIN``, stored.

    Each value of ``toxic`` has up to half of them, so rare toxic marks are all there.
    """
    marks = own_columns(labels, "doc_id", "quality", "toxic").where("toxic IS NOT NULL")
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    # One row for each of two values.
    sizes = {r["t"]: r["n"] for r in marks.groupBy((F.col("toxic") == 1).alias("t")).agg(F.count("*").alias("n")).collect()}
    parts, share, weight = 1 << 30, F.lit(0), F.lit(1.0)
    for value, n in sizes.items():
        own = F.col("toxic") == 1 if value else F.col("toxic") != 1
        share = F.when(own, F.lit(min(parts, -(-size * parts // (2 * n))))).otherwise(share)
        weight = F.when(own, F.lit(max(1.0, 2 * n / size))).otherwise(weight)
    picked = marks.where(F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(parts)) < share)
    picked = store(picked.withColumn("weight", weight), "op6-marks")
    # About ``size`` rows of four numbers, so it is small enough to broadcast.
    joined = own_columns(docs, "doc_id", "text").join(F.broadcast(picked), "doc_id")
    low, toxic = F.col("quality") == 0, F.col("toxic") == 1
    return store(
        joined.where("text IS NOT NULL").select(
            "text",
            "weight",
            low.cast("int").alias("low_quality"),
            toxic.cast("int").alias("toxic"),
            (low & toxic).cast("int").alias("severe"),
        ),
        "op6-sample",
    )


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its probabilities and ``is_toxic``."""
    trained = train(labelled_sample(docs, labels), CHAIN)
    if trained is None:
        nothing = [F.lit(None).cast("double").alias(f"p_{c}") for c in CHAIN]
        return own_columns(docs, "doc_id").select("doc_id", *nothing, F.lit(False).alias("is_toxic"))
    chain, unseen = trained
    p, y, weight = (unseen[c].to_numpy(float) for c in ("toxic_p", "toxic", "weight"))
    return score(docs, chain, best_threshold(p, y, weight))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxic ones of all ``documents``, with the probability of every category."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxic_documents(docs, labels).where("is_toxic")
