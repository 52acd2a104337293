import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewatch.llm import op3_language, op6_toxicity, op10_urls
from sitewatch.llm.contexts import ContextTrees, gram_counts
from tests.llm.edge import EDGE, edge, read

TEXTS = [("x", "abracadabra abra"), ("x", "cadabra"), ("y", "xyz xyyz zzz"), ("y", "é abra")]


def _bits(data, counts, order, smoothed):
    """Code length of ``data`` byte by byte, from counts of all runs of one class."""

    def probability(context, byte):
        n = sum(counts[context + bytes([b])] for b in range(256))
        if n == 0:
            return probability(context[1:], byte) if context else 1 / 256
        d = sum(counts[context + bytes([b])] > 0 for b in range(256))
        shorter = probability(context[1:], byte) if context else 1 / 256
        k = counts[context + bytes([byte])]
        if k and not smoothed:
            return k / (n + d)
        return (k + d * shorter) / (n + d)

    return -sum(
        math.log2(probability(data[max(0, i - order) : i], data[i])) for i in range(len(data))
    )


@pytest.mark.parametrize("smoothed", [False, True])
@pytest.mark.parametrize("order", [0, 2, 4])
def test_code_lengths_are_exact(order, smoothed, spark):
    rows = spark.createDataFrame(TEXTS, "class string, text string").repartition(3)
    trees = ContextTrees(gram_counts(rows, order).toPandas(), order, smoothed)
    texts = [b"abracadabra", b"", b"zzzyx", "é中 abra".encode(), b"q"]
    offsets = np.cumsum([0, *map(len, texts)])
    got = trees.code_lengths(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for k, label in enumerate(trees.classes):
        counts = Counter()
        for own, text in TEXTS:
            data = text.encode()
            if own == label:
                counts.update(
                    data[i : i + n] for n in range(1, order + 2) for i in range(len(data) - n + 1)
                )
        expected = [_bits(t, counts, order, smoothed) for t in texts]
        assert got[:, k] == pytest.approx(expected, rel=1e-4, abs=1e-4)


def test_language_of_held_out_texts(spark):
    got = op3_language.op3_language(spark, "/root/testdata/sf0.01")
    rows = got.join(read(spark, "documents", "0.01").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {
        r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2
    }
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_edge_rows(spark):
    docs = edge(spark)
    trees = op3_language.train(docs)
    rows = op3_language.predict(docs, trees).collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de") and 0 < r.score <= 1
    assert op3_language.train(docs.limit(0)) is None
    assert {r.lang_pred for r in op3_language.predict(docs, None).collect()} == {"und"}
    assert op3_language.predict(docs.limit(0), trees).count() == 0


def test_url_rules(spark):
    cases = {
        "http://net/x": ("net", "/x", "net/", "block"),
        "https://A.Example.NET/en/1?q#f": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/EN/1": ("example.net", "/EN/1", "net/", "block"),
        "http://badexample.com/de/": ("badexample.com", "/de/", None, None),
        "http://x.example.com/de/": ("x.example.com", "/de/", "example.com/de/", "block"),
        "http://a.org/fr/": ("a.org", "/fr/", "org/fr/", "allow"),
        "http://a.net": ("a.net", "", None, None),
        "http://a.net?x=/y": ("a.net", "", None, None),
        "x://http://b.net/": ("http:", "//b.net/", None, None),
        "no host": ("", "", None, None),
        "": ("", "", None, "block"),
        None: ("", "", None, "block"),
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)] + [(None, None)] * 2, "page_id long, url string")
    pages = pages.withColumn("host", F.lit(1)).withColumn("rule", F.lit(2))
    got = {r.page_id: r for r in op10_urls.judge(pages).collect()}
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        row = got[i]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")
    assert op10_urls.judge(pages).count() == len(cases) + 2
    assert op10_urls.judge(pages.limit(0)).count() == 0


def test_url_rules_are_those_of_sql(spark):
    sql = """
        WITH parts AS (
          SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
          FROM '/root/testdata/sf0.1/pages.parquet'
        ),
        rules(h, p) AS (VALUES ('net', '/'), ('example.net', '/en/'), ('example.com', '/de/'), ('org', '/fr/'))
        SELECT page_id, host, path, arg_max(h || p, length(h || p))
        FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        GROUP BY ALL"""
    got = op10_urls.match(read(spark, "pages", "0.1")).select("page_id", "host", "path", "rule").collect()
    assert sorted(map(tuple, got)) == sorted(duckdb.sql(sql).fetchall())


def test_url_models_agree_with_unseen_rules(spark):
    matched = op10_urls.match(read(spark, "pages", "0.1").select("page_id", "url"))
    learned = op10_urls.train(matched.where("page_id % 2 = 0"))
    rows = matched.where("page_id % 2 = 1 AND decided IS NOT NULL").toPandas()
    import pyarrow as pa

    x = learned.slope * learned.scores(pa.array(rows["url"])) + learned.shift
    assert ((x >= 0) == (rows["decided"] == "allow")).mean() > 0.97


def test_toxicity_of_unseen_documents(spark):
    docs, labels = read(spark, "documents", "0.1"), read(spark, "labels", "0.1")
    known = labels.where("doc_id % 3 != 0")
    found = op6_toxicity.toxic_documents(docs, known)
    unseen = found.join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    assert len(found.columns) == 2 + len(op6_toxicity.CHAIN)
    hits = (unseen["is_toxic"] & (unseen["toxic"] == 1)).sum()
    # One toxic text in fifteen has no telling word; rare languages have a dozen to learn from.
    assert hits / (unseen["toxic"] == 1).sum() > 0.75
    assert hits / unseen["is_toxic"].sum() > 0.95


def test_toxicity_of_edge_rows(spark):
    docs = edge(spark)
    labels = [(1, 1, 0), (3, 0, 1), (3, None, 1), (7, 0, 1), (9, 1, 0), (None, 1, 1), (77, 1, 1), (4, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(1))
    rows = op6_toxicity.toxic_documents(docs, labels).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.p_toxic <= 1 for r in rows)
    assert op6_toxicity.toxic_documents(docs.limit(0), labels).count() == 0
    nothing = op6_toxicity.toxic_documents(docs, labels.limit(0)).collect()
    assert len(nothing) == len(EDGE) and not any(r.is_toxic for r in nothing)


def test_later_models_use_earlier_probabilities(spark):
    # Texts of equal features are in one fold, so there have to be several of each kind.
    rows = [(f"{'red' if i % 2 else 'blue'} {'abcdef'[i % 6]}w {'vwxyz'[i % 5]}q", i % 2, i % 2, 1.0) for i in range(60)]
    sample = spark.createDataFrame(rows, "text string, first int, second int, weight double")
    chain, unseen = op6_toxicity.train(sample, ("first", "second"), n_features=24)
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1
    assert ((unseen["second_p"] > 0.5) == (unseen["second"] == 1)).all()


def _rare(spark, n, every):
    """Clean texts, and toxic ones with two words found nowhere else; some without a quality."""
    text = lambda i: f"the cat number {i % 977} sat on mat {i % 89}" + " vilest scum" * (i % every == 7)
    rows = [(i, text(i), None if i % 5 == 2 else 1, int(i % every == 7)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    return docs.select("doc_id", "text"), docs.select("doc_id", "quality", "toxic")


def test_rare_toxic_texts_are_found(spark):
    docs, labels = _rare(spark, 100_000, 2_500)
    rows = op6_toxicity.toxic_documents(docs, labels).where("is_toxic").collect()
    found = {r.doc_id for r in rows}
    assert len(found & set(range(7, 100_000, 2_500))) >= 36
    assert len(found) <= 44


def test_chain_is_that_of_plain_formulas(spark):
    """Logistic models fitted by plain gradient steps, the second over the first one's log-odds."""
    rows = [
        (f"{'abc'[i % 3]}w {'de'[i % 2]}x {'fghij'[i % 5]}y", int(i % 3 == 0 or i % 10 == 1), int(i % 5 < 2), 1.0)
        for i in range(90)
    ]
    sample = spark.createDataFrame(rows, "text string, first int, second int, weight double")
    chain, unseen = op6_toxicity.train(sample, ("first", "second"), n_features=40, folds=3)
    data, bounds = [r[0].encode() for r in rows], np.cumsum([0, *(len(r[0]) for r in rows)])
    x = chain.lexicon.matrix(np.frombuffer(b"".join(data), np.uint8), bounds).astype(float)
    p = chain.probabilities(x)
    x = np.concatenate([x, np.ones((90, 1))], axis=1)

    def fitted(x, y):
        w = np.zeros(x.shape[1])
        penalty = np.r_[np.ones(x.shape[1] - 1), 1e-3]
        for _ in range(40_000):
            w += 0.01 * (x.T @ (y - 1 / (1 + np.exp(-x @ w))) - penalty * w)
        return w

    y = np.array([r[1] for r in rows], float)
    first = 1 / (1 + np.exp(-x @ fitted(x, y)))
    assert p[:, 0] == pytest.approx(first, abs=2e-3)
    packed = [np.packbits(row[:-1].astype(bool)).tobytes() for row in x]
    fold = np.array([zlib.crc32(b) % 3 for b in packed])
    # Equal texts are in one fold, so no model is asked about a text it has learned from.
    assert len({(b, f) for b, f in zip(packed, fold)}) == len(set(packed))
    own = np.zeros(90)
    for k in range(3):
        if (fold == k).any():
            w = fitted(x[fold != k], y[fold != k])
            own[fold == k] = 1 / (1 + np.exp(-x[fold == k] @ w))
    mine = sorted(zip(packed, own))
    assert np.sort(unseen["first_p"].to_numpy()) == pytest.approx(np.sort([v for _, v in mine]), abs=2e-3)
    logit = lambda v: np.log(v / (1 - v))
    w = fitted(np.insert(x, -1, logit(own), axis=1), np.array([r[2] for r in rows], float))
    second = 1 / (1 + np.exp(-np.insert(x, -1, logit(first), axis=1) @ w))
    assert p[:, 1] == pytest.approx(second, abs=5e-3)


@pytest.mark.parametrize("run", ["toxicity", "urls"])
def test_file_layout_decides_nothing(run, spark, tmp_path):
    found = []
    for parts in (1, 7):
        if run == "urls":
            pages = read(spark, "pages", "0.1").select("page_id", "url").repartition(parts)
            got = op10_urls.judge(pages, per_class=200)
        else:
            docs = read(spark, "documents", "0.01").repartition(parts)
            got = op6_toxicity.toxic_documents(docs, read(spark, "labels", "0.01").repartition(parts))
        found.append(sorted(map(repr, (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in got.collect()))))
    assert found[0] == found[1]


def test_language_is_that_of_the_shortest_code(spark):
    """``lang_pred`` and ``score`` from code lengths worked out byte by byte."""
    learned = [(1, "the mat and the cat", "en"), (2, "der hut und die maus", "de"), (3, None, "de"), (4, "le chat", None)]
    docs = spark.createDataFrame(learned, "doc_id long, text string, lang string")
    trees = op3_language.train(docs, order=2)
    counts = {}
    for label in ("de", "en"):
        counts[label] = Counter()
        for _, text, lang in learned:
            data = (text or "").encode()
            if lang == label:
                counts[label].update(data[i : i + n] for n in range(1, 4) for i in range(len(data) - n + 1))
    texts = ["the hat", "die und das", "chat et rat", "x", "", None, "7 8"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in op3_language.predict(asked, trees).collect():
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        bits = {k: _bits(r.text.encode(), counts[k], 2, False) for k in counts}
        assert r.lang_pred == min(bits, key=lambda k: (bits[k], k))
        share = 1 / sum(2 ** (min(bits.values()) - b) for b in bits.values())
        assert r.score == pytest.approx(share, rel=1e-3)


def test_urls_of_any_length_and_ties(spark):
    urls = ["http://a.org/fr/x", "http://b.net/x", "http://c.org/" + "y" * 200_000, "http://c.org/y"]
    pages = spark.createDataFrame(list(enumerate(urls * 30)), "page_id long, url string")
    rows = op10_urls.judge(pages).collect()
    assert {r.verdict for r in rows if r.page_id % 4 == 0} == {"allow"}
    assert {r.verdict for r in rows if r.page_id % 4 == 1} == {"block"}
    for r in rows:
        if r.rule is None:
            assert r.verdict == ("allow" if r.probability >= 0.5 else "block")
    one_sided = spark.createDataFrame([(1, "http://a.org/fr/x"), (2, "http://z.de/")], "page_id long, url string")
    assert {(r.verdict, r.probability) for r in op10_urls.judge(one_sided).collect()} == {("allow", 1.0)}


def test_calibration_curve_is_that_of_plain_steps():
    scores = np.array([-2.0, -1.0, -0.5, 0.1, 0.4, 1.5, 2.0, -0.1])
    accepted = np.array([0, 0, 1, 0, 1, 1, 1, 0], bool)
    w = np.zeros(2)
    x = np.stack([scores, np.ones(8)], axis=1)
    weight = np.where(accepted, 0.5 / accepted.mean(), 0.5 / (1 - accepted.mean()))
    ridge = np.array([1e-2, 1e-6]) * 8**0.5
    for _ in range(20_000):
        w += 0.05 * (x.T @ (weight * (accepted - 1 / (1 + np.exp(-x @ w)))) - ridge * w)
    assert op10_urls._fit_curve(scores, accepted) == pytest.approx(tuple(w), abs=1e-4)
