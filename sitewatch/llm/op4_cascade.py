"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Base counts are computed for every document. Further rules reject documents that are no prose.
Each rule has a cost, timed on a sample, and a selectivity, the share of the sample it rejects;
rules run in the order of rejections per second, and a rule is evaluated only for documents that
all rules before it have passed. The order changes what a document costs, never its verdict.

One job times all rules: each is evaluated between two readings of the clock, ``REPEATS`` times
for each row of the sample, and the shortest time of a row counts.

Defined cases: a NULL or empty text has no word, so the base test fails; equal lines count as
copies with their white space as it is; repeated rows are judged each; an empty table gives no
row; other columns, a NULL ``doc_id`` too, go through unchanged, but for those named like a result,
which are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import own_columns

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SAMPLE_ROWS = 2000
REPEATS = 5

_WORDS = r"[^\x20\x09-\x0D]+"
_BLANK = r"[\x20\x09-\x0D]+"


_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
_VERDICT = ["rejected_by", "kept"]


class Rule(NamedTuple):
    """``rejects`` is a condition over a document's text and its base columns."""

    name: str
    rejects: Column


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), _BLANK, " ")
    return F.filter(F.split(trimmed, " ", -1), lambda w: w != "")


def _repeated(words: Column) -> Column:
    """How many words lie in three-word windows found twice or more in the text.

    Windows are told apart by a 64-bit hash of their three words. Texts whose windows all differ,
    by far the most, are done after one set of hashes; in the others each window's hash is sorted
    with its place, so equal ones are neighbours.
    """

    def covered(marks: Column) -> Column:
        places = F.array_sort(
            F.transform(
                F.filter(
                    marks,
                    lambda m, i: (m["h"] == F.get(marks, i - 1)["h"])
                    | (m["h"] == F.get(marks, i + 1)["h"]),
                ),
                lambda m: m["i"],
            )
        )
        # Of each window, the words before the next window's first.
        return _let(
            places,
            lambda p: F.aggregate(
                F.transform(
                    p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))
                ),
                F.lit(0).cast("long"),
                lambda total, n: total + n,
            ),
        )

    def count(w: Column) -> Column:
        hashes = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
        )
        marks = lambda h: F.sort_array(
            F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        )
        return _let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
                _let(marks(h), covered)
            ),
        )

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(_let(words, count))


def base(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts and ``base_failed``; ``docs`` needs ``text``."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(
        F.split(text, "\n", -1), lambda line: F.regexp_replace(line, _BLANK, "") != ""
    )
    long = lambda c: c.cast("long")
    names = [c for c in docs.columns if c not in (*_BASE, *_VERDICT)]
    counted = own_columns(docs, *names).withColumn("__words", words_of(F.col("text"))).select(
        "*",
        long(F.size("__words")).alias("n_words"),
        long(F.length(F.regexp_replace(text, _BLANK, ""))).alias("word_chars"),
        long(F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))).alias("n_symbols"),
        long(_let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).alias("n_dup_lines"),
        _repeated(F.col("__words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return counted.drop("__words").withColumn("base_failed", failed)


def prose_rules() -> list[Rule]:
    """Rules that prose of any language passes by a wide margin."""
    text, n_words = F.coalesce("text", F.lit("")), F.greatest("n_words", F.lit(1))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    digits = F.length(F.regexp_replace(text, r"[^\p{N}]+", ""))
    lines = F.length(F.regexp_replace(text, "[^\n]+", "")) + 1
    marked = F.regexp_replace(text, r"(?m)^[ \t]*[-*•][ \t]", "\x00")
    bullets = F.length(F.regexp_replace(marked, "[^\x00]+", ""))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > 3 * n_words),
        Rule("word_length", (F.col("word_chars") < 2 * n_words) | (F.col("word_chars") > 25 * n_words)),
        Rule("dup_lines", 10 * F.col("n_dup_lines") > 6 * lines),
        Rule("letters", 10 * letters < 6 * F.col("word_chars")),
        Rule("digits", 10 * digits > 3 * F.col("word_chars")),
        Rule("bullets", 10 * bullets > 9 * lines),
    ]


def ordered(
    docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS
) -> list[tuple[Rule, float, float]]:
    """``rules`` by rejections per second, with the seconds and the share each rejects.

    The sample is about ``sample_rows`` rows, picked by a hash, whatever the table's size, and of
    those the ones that passed the base test. ``docs`` needs ``doc_id`` and ``text``.
    """
    parts = 1 << 30
    share = min(parts, -(-sample_rows * parts // max(docs.count(), 1)))
    picked = F.pmod(F.xxhash64("doc_id", "text", F.lit(4)), F.lit(parts)) < share
    sample = base(own_columns(docs, "doc_id", "text").where(picked)).where(~F.col("base_failed"))
    now = F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")
    readings = [now]
    for rule in rules:
        readings += [F.coalesce(rule.rejects, F.lit(False)).cast("long"), now]
    # An array is filled from the first to the last, so each rule lies between its two readings.
    rounds = F.explode(F.sequence(F.lit(1), F.lit(REPEATS))).alias("round")
    numbered = sample.withColumn("row", F.monotonically_increasing_id()).select("*", rounds)
    read = numbered.select("row", F.array(*readings).alias("r"))
    spent = [F.min(F.col("r")[2 * k + 2] - F.col("r")[2 * k]).alias(f"t{k}") for k in range(len(rules))]
    hits = [F.max(F.col("r")[2 * k + 1]).alias(f"x{k}") for k in range(len(rules))]
    each = read.groupBy("row").agg(*spent, *hits)
    sums = [F.sum(f"{c}{k}").alias(f"{c}{k}") for c in "tx" for k in range(len(rules))]
    total = each.agg(F.count("*").alias("n"), *sums).first()
    measured = [
        (rule, max(total[f"t{k}"] or 0, 1) / 1e9, (total[f"x{k}"] or 0) / max(total["n"], 1))
        for k, rule in enumerate(rules)
    ]
    return sorted(measured, key=lambda m: m[2] / m[1], reverse=True)


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, evaluated only as far as needed; else NULL."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    return verdict


def judge(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with base counts, ``base_failed``, ``rejected_by`` and ``kept``."""
    counted = base(docs)
    rules = prose_rules() if rules is None else rules
    best = [rule for rule, _, _ in ordered(docs, rules, sample_rows)]
    rejected = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(best))
    return counted.withColumn("rejected_by", rejected).withColumn(
        "kept", F.col("rejected_by").isNull()
    )


def op4_cascade(spark, sf_dir: str) -> DataFrame:
    """The base counts and the verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(own_columns(docs, "doc_id", "text")).drop("text", "rejected_by")
