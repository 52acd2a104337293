"""The URL models against those of ``ContextTrees`` over every decided URL."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitewatch.llm import op10_urls
from sitewatch.llm.contexts import ContextTrees, gram_counts

SCHEMA = "page_id long, url string"
ODD = [None, "", "x", "\x00\x00a", "no host", "http://c.de/\x00", "http://中文.de/é", "http://d.de/" + "ab" * 3000]


def _pages(spark, n):
    """``n`` URLs for each verdict, as many that no rule decides, and odd ones."""
    site = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 6), 16, 36)
    kinds = [
        F.concat(F.lit("http://"), site, F.lit(".org/fr/"), F.col("id") % 7919),
        F.concat(F.lit("https://win-"), site, F.lit(".net/spin?n="), F.col("id") % 631),
        F.concat(F.lit("http://"), F.when(F.col("id") % 2 == 0, "win-").otherwise(""), site, F.lit(".de/")),
    ]
    urls = spark.range(n).select(F.explode(F.array(*kinds)).alias("url"))
    return urls.select(F.xxhash64("url").alias("page_id"), "url").union(
        spark.createDataFrame([(i, u) for i, u in enumerate(ODD)] + [(None, ODD[-1])] * 2, SCHEMA)
    )


def _reference(pages, order=op10_urls.ORDER):
    """The trees of all decided URLs that are not held out, the curve, and URL -> probability."""
    matched = op10_urls.match(pages).select("url", "decided")
    held = F.pmod(F.xxhash64("url", F.lit(11)), F.lit(4)) == 0
    seen = matched.where(~held).where("decided IS NOT NULL").select(F.col("decided").alias("class"), F.col("url").alias("text"))
    trees = ContextTrees(gram_counts(seen, order).toPandas(), order, smoothed=True)

    def scores(urls):
        data = [(u or "").encode() for u in urls]
        bits = trees.code_lengths(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        return (bits[:, 1] - bits[:, 0]) / np.maximum([len(d) for d in data], 1)

    rows = matched.where(held).where("decided IS NOT NULL").toPandas()
    slope, shift = op10_urls._fit_curve(scores(rows["url"]), (rows["decided"] == "allow").to_numpy())
    urls = [r.url for r in matched.select("url").distinct().collect()]
    return scores, dict(zip(urls, 1 / (1 + np.exp(-np.clip(slope * scores(urls) + shift, -30, 30)))))


def test_every_decided_url_is_learned_from(spark):
    """There are more decided URLs of each verdict than a training sample of 20,000 has."""
    pages = _pages(spark, 26_000)
    _, expected = _reference(pages)
    found = op10_urls.judge(pages)
    judged = found.join(pages.select("page_id", "url").distinct(), "page_id").toPandas()
    assert len(judged) == 3 * 26_000 + len(ODD)
    assert (judged["rule"] == "org/fr/").sum() == (judged["rule"] == "net/").sum() == 26_000
    assert judged["probability"].to_numpy() == pytest.approx([expected[u] for u in judged["url"]], abs=1e-8)
    assert found.where("page_id IS NULL").count() == 2


@pytest.mark.parametrize("order", [0, 2, 6])
def test_scores_are_those_of_context_trees(order, spark):
    pages = _pages(spark, 60)
    scores, _ = _reference(pages, order)
    model = op10_urls.train(op10_urls.match(pages), order=order)
    urls = [*ODD, "http://unseen.org/fr/€", "http://win-7.net/"]
    assert model.scores(pa.array(urls)) == pytest.approx(scores(urls), rel=1e-6, abs=1e-6)


def test_lots_decide_nothing(spark, monkeypatch):
    pages = _pages(spark, 300).repartition(3)
    found = []
    for size in (op10_urls.LOT_BYTES, 2_000):
        monkeypatch.setattr(op10_urls, "LOT_BYTES", size)
        found.append(sorted(map(repr, op10_urls.judge(pages).collect())))
    assert found[0] == found[1]
    lots = op10_urls._in_lots(pages).groupBy("lot").agg(F.sum(F.octet_length("url")).alias("n"), F.count("*").alias("rows"))
    assert lots.count() > 20 and lots.where("n > 3000 AND rows > 1").count() == 0


def test_model_stays_with_spark(spark):
    """Counts over all decided URLs that are not held out; nothing of their number is collected."""
    pages = _pages(spark, 500)
    model = op10_urls.train(op10_urls.match(pages))
    held = F.pmod(F.xxhash64("url", F.lit(11)), F.lit(4)) == 0
    seen = op10_urls.match(pages).where(~held).where("decided IS NOT NULL")
    # Every byte is the end of one longest run.
    bytes_of = {r[0]: r[1] for r in seen.groupBy("decided").agg(F.sum(F.octet_length("url"))).collect()}
    assert model.runs.agg(F.sum("allow"), F.sum("block")).first() == (bytes_of["allow"], bytes_of["block"])
