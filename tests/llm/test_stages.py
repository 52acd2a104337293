"""Stages of the pipeline against brute force."""

import os
from collections import Counter
from itertools import combinations

import corpus_pipeline
from sitewatch.session import shared_dir
from tests.llm.edge import PROSE, edge, read
from tests.llm.test_repeats import _kept

STAGES = dict(corpus_pipeline.STAGES)


def _grams(text, n):
    own = tuple((text or "").encode().lower().split())
    if len(own) < n:
        return frozenset([own]) if own else frozenset()
    return frozenset(own[i : i + n] for i in range(len(own) - n + 1))


def _similarity(a, b):
    return len(a & b) / len(a | b)


def _left_of_near(texts, n):
    """The smallest id of each component of near duplicates, every pair compared."""
    sets = {i: _grams(t, n) for i, t in texts.items()}
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if small and 5 * small >= 4 * large and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {i for i in texts if top(i) == i}


def test_near_duplicates_take_five_words(spark):
    """One changed word of 40 in the middle breaks 4 shingles of 37, or 5 of 36."""
    text = [f"{w}{i}" for i, w in enumerate(PROSE[:40])]
    other = ["changed" if i == 20 else w for i, w in enumerate(text)]
    a, b = " ".join(text), " ".join(other)
    assert _similarity(_grams(a, 4), _grams(b, 4)) >= 0.8 > _similarity(_grams(a, 5), _grams(b, 5))
    docs = spark.createDataFrame([(1, a), (2, b), (3, a), (4, a + " end")], "doc_id long, text string")
    stage = STAGES["MinHash near-dedup"]
    assert {r.doc_id for r in stage(spark, docs, "").collect()} == {1, 2}


def test_near_duplicates_are_those_of_brute_force(spark):
    docs = read(spark, "documents", "0.01")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in STAGES["MinHash near-dedup"](spark, docs, "").collect()}
    assert kept == _left_of_near(texts, 5) and len(kept) > len(_left_of_near(texts, 4))


def test_texts_after_substring_dedup_are_those_of_brute_force(spark):
    docs = read(spark, "documents")
    rows = docs.collect()
    expected = {i: (text if removed else None) for (i, _), (_, removed, text) in _kept(rows).items()}
    got = {r.doc_id: r.text for r in STAGES["substring dedup"](spark, docs, "").collect()}
    assert got == {r.doc_id: expected[r.doc_id] if expected[r.doc_id] is not None else r.text for r in rows}


def test_decontamination_drops_what_shares_ten_words(spark):
    docs, items = read(spark, "documents", "0.01"), read(spark, "benchmark", "0.01")

    def runs(text):
        return _grams("".join(c if c.isalnum() else " " for c in text), 10)

    known = frozenset().union(*(runs(r.text) for r in items.collect()))
    kept = {r.doc_id for r in docs.collect() if not runs(r.text) & known}
    stage = STAGES["benchmark decontamination"]
    assert {r.doc_id for r in stage(spark, docs, "/root/testdata/sf0.01").collect()} == kept


def _three_texts(spark):
    t, u, v = (" ".join(f"{c}{k}" for k in range(40)) for c in "tuv")
    rows = [(0, t, 0.5), (5, t, 1.5), (5, u, 2.5), (7, v, 3.5), (7, v, 3.5)]
    return t, u, v, spark.createDataFrame(rows, "doc_id long, text string, score double")


def test_near_duplicates_keep_every_text_of_a_shared_id_once(spark):
    t, u, v, docs = _three_texts(spark)
    left = STAGES["MinHash near-dedup"](spark, docs, "").collect()
    assert sorted(map(tuple, left)) == [(0, t, 0.5), (5, u, 2.5), (7, v, 3.5)]


def test_stages_carry_all_columns_of_edge_rows(spark):
    """Clashing extra columns go through unchanged, and an empty table stays one."""
    docs, sf_dir = edge(spark), "/root/testdata/sf0.001"
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    before = Counter(repr(tuple(r)) for r in docs.select("doc_id", *others).collect())
    for name, stage in list(STAGES.items())[:-1]:
        left = stage(spark, docs, sf_dir)
        assert left.columns == docs.columns, name
        rows = left.collect()
        assert rows and not Counter(repr(tuple(r[c] for c in ["doc_id", *others])) for r in rows) - before, name
        if name == "substring dedup":
            assert len(rows) == docs.count()
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name


def test_decontamination_drops_the_text_that_leaks_only(spark):
    item = read(spark, "benchmark").first().text
    docs = spark.createDataFrame([(1, "so " + item), (1, "a clean text"), (2, None)], "doc_id long, text string")
    left = STAGES["benchmark decontamination"](spark, docs, "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id, r.text or "") for r in left) == [(1, "a clean text"), (2, "")]


def test_run_removes_what_stages_keep_for_themselves(spark, tmp_path):
    before = set(os.listdir(f"{shared_dir(spark)}/sitewatch"))
    corpus_pipeline.run(spark, "/root/testdata/sf0.001").count()
    new = set(os.listdir(f"{shared_dir(spark)}/sitewatch")) - before
    assert {n.rsplit("-", 1)[0] for n in new} == {
        "pipeline-language-ID", "pipeline-MinHash-near-dedup", "pipeline-substring-dedup",
        "pipeline-benchmark-decontamination", "op9-stream", "op9-records", "op9-joined"}
