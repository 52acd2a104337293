"""URL filter: rules first, then the ratio of two character language models.

Rules ``(verdict, host, path)`` fit a host and its subdomains if the URL's path starts with the
rule's; the longest wins. What they decide also trains the method for the rest: two smoothed
variable-order Markov models over the bytes of accepted and of rejected URLs. A URL's score is the
difference of its log-likelihoods, in bits, divided by its length; a logistic curve, fitted to
decided URLs that the models have not seen, turns it into a probability, and half decides.

Training takes every decided URL: a quarter of them, by a hash, is held out for the calibration, the
others are counted. The models are tables and stay with Spark. A lot of URLs is reduced to its
distinct runs of bytes, the longest that ends at each byte; their counts are summed over all lots,
their code lengths follow level by level from those of the runs shorter by a byte, and return to
the lots that have them. The curve is fitted to sums over all held-out URLs. ``per_class`` can bound
the decided URLs of each verdict for those who want a smaller model; the query does not set it.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path and fits no rule;
a NULL or empty URL is blocked; if the rules decide nothing on one side, the rest is allowed; a
probability of exactly one half allows; a URL counts in full, however long;
repeated rows are judged each; a NULL ``page_id`` goes through; other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from sitewatch.llm.common import own_columns, store, text_slices

ORDER = 5
ALLOW, BLOCK = "allow", "block"
LOT_BYTES = 1 << 20

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_ROW_BYTES = 64  # what a row adds to a lot besides its URL
_RUNS = f"lot long, run long, {ALLOW} long, {BLOCK} long"
_TERMS = 6
_UNIT = 1 << 32  # sums of whole numbers do not depend on their order


class UrlRule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule(BLOCK, "net", "/"),
    UrlRule(ALLOW, "example.net", "/en/"),
    UrlRule(BLOCK, "example.com", "/de/"),
    UrlRule(ALLOW, "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def match(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, the ``rule`` that wins and its ``decided`` verdict."""
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col(
            "path"
        ).startswith(r.path)
        rule = F.when(fits, F.lit(r.name)).otherwise(rule)
        decided = F.when(fits, F.lit(r.verdict)).otherwise(decided)
    split = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return split.withColumn("rule", rule).withColumn("decided", decided)


def _in_lots(rows: DataFrame) -> DataFrame:
    """``rows`` with ``lot``: those of about ``LOT_BYTES`` that lie together have the same."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, taken = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.binary_length(batch.column("url")).fill_null(0).to_numpy(zero_copy_only=False)
            upto = taken + np.cumsum(sizes.astype(np.int64) + _ROW_BYTES)
            taken = int(upto[-1]) if len(upto) else taken
            columns = [*batch.columns, pa.array(first + upto // LOT_BYTES, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lot"])

    return rows.mapInArrow(deal, StructType([*rows.schema.fields, StructField("lot", LongType())]))


def _longest_runs(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """For each byte the run of up to ``order`` + 1 bytes of its text that ends there.

    A run is a number: its bytes behind a 1, so that runs of different lengths differ.
    """
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    runs = data.astype(np.int64)
    for k in range(1, order + 1):
        at = np.flatnonzero(place >= k)
        runs[at] |= data[at - k].astype(np.int64) << (8 * k)
    return runs | np.int64(1) << (8 * np.minimum(place + 1, order + 1))


def _runs(lots: DataFrame, order: int) -> DataFrame:
    """The distinct runs of each lot, and how often URLs to ``learn`` from have them."""

    def count(lot: pa.Table) -> pa.Table:
        found, learned = [], []
        learn = np.array(lot.column("learn").to_pylist(), object)
        for lo, hi, data, offsets in text_slices(lot.column("url")):
            found.append(_longest_runs(data, offsets, order))
            learned.append(np.repeat(learn[lo:hi], np.diff(offsets)))
        runs, where = np.unique(np.concatenate(found), return_inverse=True)
        of_byte = np.concatenate(learned)
        counts = [
            np.bincount(where[of_byte == verdict], minlength=len(runs)) for verdict in (ALLOW, BLOCK)
        ]
        number = np.full(len(runs), lot.column("lot")[0].as_py(), np.int64)
        arrays = [pa.array(x, pa.int64()) for x in (number, runs, *counts)]
        return pa.Table.from_arrays(arrays, names=["lot", "run", ALLOW, BLOCK])

    return lots.select("lot", "url", "learn").groupBy("lot").applyInArrow(count, _RUNS)


def _last(run: Column, n: int) -> Column:
    """The last ``n`` bytes of a longer run, as a run."""
    return run % F.lit(1 << 8 * n) + F.lit(1 << 8 * n)


def _code_lengths(runs: DataFrame, order: int) -> DataFrame:
    """``run`` with the bits of its last byte under both models, for all of ``runs (run, allow, block)``.

    The models are those of ``ContextTrees``, smoothed. A run that URLs to learn from do not have
    counts 0 and has the bits that the escape from its context and the run shorter by its first byte
    leave. As there, the bits of the longest known run, and then the escapes from contexts, the
    longest first, are added in single precision.
    """
    verdicts = (ALLOW, BLOCK)
    sums = [F.sum(v).alias(v) for v in verdicts]
    levels = range(1, order + 2)
    run = F.col("run")
    ends = [
        F.when(run >= F.lit(1 << 8 * n), F.struct(F.lit(n).alias("level"), _last(run, n).alias("run")))
        for n in levels
    ]
    ends = F.explode(F.filter(F.array(*ends), lambda end: end.isNotNull())).alias("end")
    nodes = runs.groupBy("run").agg(*sums).select(ends, *verdicts).groupBy("end").agg(*sums)
    nodes = nodes.select("end.level", "end.run", *verdicts)

    context = Window.partitionBy(F.shiftright("run", 8))
    steps = []
    for v in verdicts:
        total, distinct = F.sum(v).over(context), F.sum((F.col(v) > 0).cast("long")).over(context)
        steps += [
            F.when(F.col(v) > 0, F.col(v) / (total + distinct)).alias(f"{v}_share"),
            F.when(total > 0, F.log2((total + distinct) / distinct)).otherwise(0.0).alias(f"{v}_escape"),
        ]
    known = (F.col(ALLOW) + F.col(BLOCK) > 0).alias("known")
    nodes = store(nodes.select("level", "run", known, *steps), "op10-nodes")

    found: list[DataFrame] = []
    for level in levels:
        at = nodes.where(F.col("level") == level)
        if found:
            shorter = found[-1].withColumnRenamed("run", "__end")
            at = at.join(shorter, _last(run, level - 1) == F.col("__end"))
        else:
            for v in verdicts:
                at = at.withColumn(f"{v}_bits", F.lit(8.0)).withColumn(f"{v}_known", F.lit(0.0).cast("float"))
                at = at.withColumn(f"{v}_past", F.array().cast("array<float>"))
        columns = [run]
        for v in verdicts:
            escape, past = F.col(f"{v}_escape"), F.col(f"{v}_past")
            # Past the empty context any byte takes 8 bits.
            left = escape.cast("float") + F.lit(0.0 if found else 8.0).cast("float")
            below = escape + F.col(f"{v}_bits")
            own = -F.log2(F.col(f"{v}_share") + F.pow(F.lit(2.0), -below))
            bits = F.coalesce(own, below)
            columns += [
                bits.alias(f"{v}_bits"),
                F.when(F.col("known"), bits.cast("float")).otherwise(F.col(f"{v}_known")).alias(f"{v}_known"),
                F.when(F.col("known"), F.array().cast("array<float>"))
                .otherwise(F.concat(F.array(left), past))
                .alias(f"{v}_past"),
            ]
        found.append(store(at.select(*columns), "op10-level"))
    bits = [F.aggregate(f"{v}_past", F.col(f"{v}_known"), lambda a, b: a + b).alias(v) for v in verdicts]
    return reduce(DataFrame.unionAll, found).select("run", *bits)


def _score(rows: DataFrame, order: int, learned: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``rows (url, learn, ...)`` with their ``score``, and the runs of their lots.

    A score is the number of bits by which a byte of the URL is likelier among the accepted ones.
    The models are counted over the URLs with a verdict to ``learn`` and over ``learned``, runs
    counted before.
    """
    lots = store(_in_lots(rows), "op10-lots")
    runs = store(_runs(lots, order), "op10-runs")
    counts = runs.select("run", ALLOW, BLOCK)
    bits = _code_lengths(counts if learned is None else counts.unionAll(learned), order)
    asked = runs.select("lot", "run").join(bits, "run")

    def score(lot: pa.Table, known: pa.Table) -> pa.Table:
        in_order = np.argsort(known.column("run").to_numpy())
        runs = known.column("run").to_numpy()[in_order]
        allow, block = (known.column(v).to_numpy()[in_order].astype(float) for v in (ALLOW, BLOCK))
        gain = np.rint((block - allow) * _UNIT).astype(np.int64)
        scores = np.zeros(lot.num_rows)
        for lo, hi, data, offsets in text_slices(lot.column("url")):
            sizes = np.diff(offsets)
            full = np.flatnonzero(sizes)
            if len(full):
                of_byte = gain[np.searchsorted(runs, _longest_runs(data, offsets, order))]
                scores[lo + full] = np.add.reduceat(of_byte, offsets[:-1][full]) / _UNIT / sizes[full]
        return lot.drop_columns(["lot"]).append_column("score", pa.array(scores))

    schema = StructType([*rows.schema.fields, StructField("score", DoubleType())])
    scored = lots.groupBy("lot").cogroup(asked.groupBy("lot")).applyInArrow(score, schema)
    return store(scored, "op10-scored"), runs


class UrlModel(NamedTuple):
    """How often accepted and rejected URLs have each run, and the curve

    ``1 / (1 + exp(-(slope * score + shift)))`` of accepting.
    """

    runs: DataFrame
    order: int
    slope: float
    shift: float

    def score(self, urls: DataFrame) -> DataFrame:
        """``urls (url, ...)`` with ``score``: bits by which a byte is likelier among the accepted."""
        unlearned = urls.withColumn("learn", F.lit(None).cast("string"))
        return _score(unlearned, self.order, self.runs)[0].drop("learn")

    def scores(self, urls: pa.Array) -> np.ndarray:
        """The scores of a few URLs at hand."""
        table = pa.table({"place": np.arange(len(urls)), "url": urls.cast(pa.string())})
        found = self.score(self.runs.sparkSession.createDataFrame(table)).select("place", "score")
        return found.toPandas().sort_values("place")["score"].to_numpy()

    def probability(self, score: Column) -> Column:
        x = F.lit(self.slope) * score + F.lit(self.shift)
        return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(30.0)), F.lit(-30.0))))


def _sums(scores: np.ndarray, accepted: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Of both sides, rejected first: the terms of gradient and Hessian, and the number of URLs."""
    p = 1 / (1 + np.exp(-np.clip(w[0] * scores + w[1], -30, 30)))
    error, spread = accepted - p, p * (1 - p)
    terms = [error * scores, error, spread * scores**2, spread * scores, spread, np.ones_like(p)]
    whole = np.rint(np.stack(terms) * _UNIT).astype(np.int64)
    return np.stack([whole[:, accepted == side].sum(axis=1) for side in (False, True)])


def _newton(sums: Callable[[np.ndarray], np.ndarray]) -> tuple[float, float]:
    """Slope and shift of a logistic curve, both sides weighted alike, by Newton's method."""
    w = np.zeros(2)
    for _ in range(50):
        found = sums(w).astype(float) / _UNIT
        n = found[:, -1]
        if not n.all():
            return 1.0, 0.0
        a, b, aa, ab, bb, _ = (0.5 * n.sum() / n) @ found
        ridge = np.diag([1e-2, 1e-6]) * n.sum() ** 0.5
        step = np.linalg.solve(np.array([[aa, ab], [ab, bb]]) + ridge, np.array([a, b]) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _fit_curve(scores: np.ndarray, accepted: np.ndarray) -> tuple[float, float]:
    """The curve of scores at hand."""
    return _newton(lambda w: _sums(scores, accepted, w))


def _fit_curve_to(held: DataFrame) -> tuple[float, float]:
    """The curve of ``held (score, accepted)``; only sums reach the driver."""
    names = [f"{side}{k}" for side in "ra" for k in range(_TERMS)]

    def total(w: np.ndarray) -> np.ndarray:
        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                scores = batch.column("score").to_numpy()
                accepted = batch.column("accepted").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pylist([dict(zip(names, _sums(scores, accepted, w).ravel().tolist()))])

        parts = held.mapInArrow(add_up, ", ".join(f"{name} long" for name in names))
        row = parts.agg(*[F.sum(F.col(name).cast("decimal(38,0)")) for name in names]).first()
        return np.array([float(v or 0) for v in row]).reshape(2, _TERMS)

    return _newton(total)


def _learn(
    rows: DataFrame, order: int = ORDER, per_class: int | None = None
) -> tuple[UrlModel, DataFrame] | None:
    """The model of the decided among ``rows (page_id, url, decided)``, and all rows with ``score``.

    None if one verdict has no example.
    """
    if order > 6:
        raise ValueError("a run has 7 bytes at most")
    used = F.col("decided").isNotNull() & F.coalesce(F.col("url") != "", F.lit(False))
    if per_class is not None:
        sizes = rows.where(used).groupBy("decided").agg(F.count("*").alias("n")).collect()
        parts, limit = 1 << 30, F.lit(0)
        for decided, n in sizes:
            share = min(parts, -(-per_class * parts // n))
            limit = F.when(F.col("decided") == decided, F.lit(share)).otherwise(limit)
        used &= F.pmod(F.xxhash64("page_id", "url", F.lit(10)), F.lit(parts)) < limit
    held = used & (F.pmod(F.xxhash64("url", F.lit(11)), F.lit(4)) == 0)
    rows = rows.withColumn("held", held).withColumn("learn", F.when(used & ~held, F.col("decided")))
    learned = rows.where("learn IS NOT NULL").groupBy("learn").agg(F.count("*")).collect()
    if {r["learn"] for r in learned} != {ALLOW, BLOCK}:
        return None
    scored, runs = _score(rows, order)
    accepted = (F.col("decided") == ALLOW).alias("accepted")
    curve = _fit_curve_to(scored.where("held").select("score", accepted))
    known = runs.where(F.col(ALLOW) + F.col(BLOCK) > 0).select("run", ALLOW, BLOCK)
    return UrlModel(known, order, *curve), scored


def train(decided: DataFrame, **training) -> UrlModel | None:
    """The model of ``decided (page_id, url, decided)``; None if one verdict has no example."""
    learned = _learn(decided.where("decided IS NOT NULL").select("page_id", "url", "decided"), **training)
    return learned and learned[0]


def judge(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, **training) -> DataFrame:
    """``pages (page_id, url)`` with host, path, rule, verdict, and the models' probability."""
    matched = match(own_columns(pages, "page_id", "url"), rules)
    learned = _learn(matched.select("page_id", "url", "decided"), **training)
    if learned is None:
        judged = matched.withColumn("probability", F.lit(1.0))
    else:
        model, scored = learned
        probability = model.probability(F.col("score")).alias("probability")
        judged = match(scored.select("page_id", "url", probability), rules)
    usable = F.coalesce(F.col("url") != "", F.lit(False))
    by_model = F.when(usable & (F.col("probability") >= 0.5), F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("decided", by_model).alias("verdict"), "probability",
    )


def op10_urls(spark, sf_dir: str) -> DataFrame:
    """The verdict on the URL of every page."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
