import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sitewatch.llm import op1_repeats, op2_templates, op8_minhash
from sitewatch.llm.components import components, merged
from tests.llm.edge import EDGE, LONG, PROSE, edge, read, words


def _kept(rows):
    """By doc_id and text: number of words, of removed ones, and the kept text."""
    seen, out = {}, {}
    for doc_id, text in sorted({(r.doc_id, r.text) for r in rows if r.doc_id is not None}):
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - 19):
            if seen.setdefault(tuple(own[i : i + 20]), (doc_id, i)) != (doc_id, i):
                gone[i : i + 20] = [True] * 20
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        out[doc_id, text] = (len(own), sum(gone), kept)
    for r in rows:
        if r.doc_id is None:
            out[None, r.text] = (len(words(r.text)), 0, " ".join(words(r.text)))
    return out


@pytest.mark.parametrize("heavy, cell, stream", [(4000, 4000, 8000), (2, 30, 3)])
def test_repeats_are_those_of_brute_force(heavy, cell, stream, spark):
    docs = read(spark, "documents").select("doc_id", F.nullif("text", F.lit("")).alias("text"))
    docs = docs.unionByName(
        edge(spark).where("doc_id IS NULL OR text IS NOT NULL").select(F.col("doc_id") + 10_000, "text").toDF("doc_id", "text")
    )
    got = op1_repeats.remove_repeats(docs, heavy=heavy, cell=cell, stream=stream).collect()
    expected = _kept(docs.where("text IS NOT NULL OR doc_id IS NULL").collect())
    assert len(got) == docs.count()
    assert sum(r.n_removed for r in got) > 500
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_text) == expected.get((r.doc_id, r.text), (0, 0, ""))


def test_repeats_leave_other_columns(spark):
    docs = edge(spark)
    got = op1_repeats.remove_repeats(docs)
    assert got.columns == [c for c in docs.columns if c != "n_words"] + ["n_words", "n_removed", "kept_text"]
    assert got.count() == len(EDGE)
    assert op1_repeats.remove_repeats(docs.limit(0)).count() == 0


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    unique = " ".join(f"u{i}" for i in range(40))
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, unique), (1, passage), (1, passage), (2, "x " + passage), (2, unique.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_key", F.lit(1))
    got = op1_repeats.remove_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == sorted(
        [(1, 40, 0, unique), (1, 30, 0, passage), (1, 30, 0, passage), (2, 31, 30, "x"), (2, 40, 0, unique.upper())]
    )


def _shingles(text):
    own = tuple((text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split())
    if len(own) < 4:
        return frozenset([own]) if own else frozenset()
    return frozenset(own[i : i + 4] for i in range(len(own) - 3))


def _near(rows):
    sets = {r.doc_id: _shingles(r.text) for r in rows if r.doc_id is not None}
    holders, root = defaultdict(list), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(sets):
        for j in {j for s in sets[i] for j in holders[s]}:
            common = len(sets[i] & sets[j])
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("block, few", [(500_000, 50), (300, 2), (300, 1)])
def test_near_duplicates_are_those_of_brute_force(block, few, spark):
    docs = read(spark, "documents").select("doc_id", "text")
    # A chain of edits, its ends far apart, and copies edited too much.
    base = PROSE * 2
    chain = [(20_000 + k, " ".join([f"e{i}" for i in range(5 * k)] + base[5 * k :])) for k in range(9)]
    spread = [
        (30_000 + k, " ".join(w if (i + k) % 11 else f"z{k}{i}" for i, w in enumerate(PROSE * 3)))
        for k in range(25)
    ]
    docs = docs.union(spark.createDataFrame(chain + spread, docs.schema)).unionByName(
        edge(spark).select((F.col("doc_id") + 40_000).alias("doc_id"), "text")
    )
    expected = _near(docs.collect())
    for r in op8_minhash.near_duplicates(docs, block=block, few=few).collect():
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            size, component = expected[r.doc_id]
            assert (r.n_shingles, r.component_id, r.kept) == (size, component, r.doc_id == component)


@pytest.mark.parametrize("few", [50, 3])
def test_overlapping_passages_that_are_not_linked(few, spark):
    """A similarity of 0.76 to the next: many meet, none is linked, but for a few that are."""
    stream = [f"w{k}" for k in range(4 * 3_000 + 32)]
    rows = [(k, " ".join(stream[4 * k : 4 * k + 32])) for k in range(3_000)]
    rows += [(10_000 + k, rows[k][1] + " end") for k in range(0, 3_000, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    expected = _near(docs.collect())
    got = {r.doc_id: r.component_id for r in op8_minhash.near_duplicates(docs, few=few).collect()}
    assert got == {k: component for k, (_, component) in expected.items()}
    assert len(set(got.values())) == 3_000


def test_rows_that_share_an_id_are_compared_by_their_texts(spark):
    t, u, v, x = (" ".join(f"{c}{k}" for k in range(40)) for c in "tuvx")
    rows = [(0, t), (5, t), (5, u), (7, v), (7, v), (8, x), (9, x + " end"), (None, t)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = op8_minhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id, r.stays) for r in got if r.doc_id is not None) == [
        (0, 0, True), (5, 0, False), (5, 5, True), (7, 7, True), (7, 7, True), (8, 8, True), (9, 8, False)]


def test_near_duplicates_of_nothing(spark):
    assert op8_minhash.near_duplicates(edge(spark).limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    known = spark.createDataFrame(list(found.items()), "id long, component long")
    more = spark.createDataFrame([(150, 33), (500, 7), (700, 800)], "a long, b long")
    assert dict(map(tuple, merged(known, more).collect())) == dict.fromkeys([*found, 500], 0) | {
        700: 700, 800: 700
    }


def test_templates_find_other_numbers_names_and_capitals(spark):
    item = "yesterday my friend Alice bought 3 red apples and 3 green pears for 5 dollars in the old market"
    docs = [
        (1, "Well. " + item + " again"),
        (2, item.replace("Alice", "Bob").replace("3", "7.5").replace("dollars", "euros")),
        (3, item.replace("3 red", "4 red")),  # one number became two
        (4, item.upper()),
        (5, " ".join(item.split()[:9])),
        (6, None),
        (None, item),
        (7, " ".join(str(i) for i in range(400))),
        (8, item.replace(" ", " ,\n")),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("h", F.lit(1))
    items = [(1, item), (1, item), (2, None), (3, "too short"), (None, item), (4, "1 2 3 4 5 6 7 8 9 10 11 12")]
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = {(r.doc_id, r.item_id): r for r in op2_templates.leaks(docs, items).collect()}
    assert set(found) == {(1, 1), (2, 1), (4, 1), (8, 1)}
    assert found[1, 1].verbatim and not found[2, 1].verbatim
    assert (found[2, 1].n_tokens, found[2, 1].n_slots) == (19, 5)
    assert op2_templates.leaks(docs.limit(0), items).count() == 0
    assert op2_templates.leaks(docs, items.limit(0)).count() == 0


def _leaks(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in op2_templates.leaks(docs, items).collect()}


def test_templates_find_names_at_the_start_and_of_several_words(spark):
    apples = "Alice has 3 apples. Bob gives her 2 more apples. How many apples does Alice have now?"
    train = "A train leaves Paris for the coast at noon and comes back to Paris before it gets dark"
    docs = [
        (1, "Carol has 5 apples. Dave gives her 4 more apples. How many apples does Carol have now?"),
        (2, train.replace("Paris", "New York")),
        (3, "Carol has 5 apples. Dave gives her 4 more apples. How many apples does Erin have now?"),
        (4, "Alice has 3 pears. Bob sells them to the old man. How many pears does Bob see there?"),
        (5, "a boat left as noted " + " ".join(train.lower().split()[5:]) + " again"),
    ]
    assert _leaks(spark, docs, [(1, apples), (2, train)]) >= {(1, 1), (2, 2)}
    assert (4, 1) not in _leaks(spark, docs, [(1, apples), (2, train)])


def test_templates_count_the_runs_of_one_alignment_together(spark):
    item = "the baker on the corner sold fresh bread and warm rolls to people from the hills and the coast before the rain began again"
    own = item.split()
    docs = [
        (1, " ".join([*own[:12], "nearly", "all", *own[12:]])),
        (2, " ".join(own[:12])),
        (3, " ".join([*own[12:], "nearly", "all", *own[:12]])),
        (4, " ".join([*own[:12], *["far"] * 60, *own[12:]])),
    ]
    assert _leaks(spark, docs, [(1, item)]) == {(1, 1)}


def test_every_text_of_an_item_and_short_items_are_searched(spark):
    long = "the miller of the quiet valley counted every sack of grain twice before the winter came"
    other = "a tall ship crossed the wide bay at dawn while gulls cried over the grey old harbour wall"
    items = [(1, long), (1, other), (2, long), (3, "What is the capital of France?"), (4, "Yes")]
    docs = [
        (1, "x " + long), (2, "y " + other), (3, "Quiz. What is the capital of France? Paris."),
        (4, "Quiz. What is the capital of Spain? Yes"), (5, "Berlin is the capital of Germany"),
        (6, "What is the name of France?"),
    ]
    assert _leaks(spark, docs, items) == {(1, 1), (1, 2), (2, 1), (3, 3), (4, 3)}


def test_items_of_one_template_are_one_class(spark):
    """400 documents and 400 items of one template meet once, not 160,000 times."""
    made = lambda a, b: f"a farmer near the old mill sold {a} sheep and {b} goats to the butcher before noon"
    items = [(i, made(i + 3, i + 5)) for i in range(400)] + [(1_000, made(7, 7))]
    docs = [(i, "Well. " + made(i + 203, i + 205)) for i in range(400)] + [(900, made(9, 9)), (901, "x")]
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit(1))
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = op2_templates.template_leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.n_items) for r in rows) == [(i, 0, 400) for i in range(400)] + [(900, 1_000, 1)]
    assert {r.doc_id for r in rows if r.verbatim} == set(range(200))
    pairs = op2_templates.leaks(docs.where("doc_id IN (0, 300, 900)"), items)
    assert pairs.groupBy("doc_id").count().orderBy("doc_id").collect() == [(0, 400), (300, 400), (900, 1)]
    assert [tuple(r) for r in pairs.where("verbatim").select("doc_id", "item_id").collect()] == [(0, 200)]


def test_short_items_of_few_words_leak_word_for_word(spark):
    items = [(1, "add 3 and 4"), (2, "add 5 and 6"), (3, "What is the capital of France?")]
    docs = [(1, "Please add 5 and 6 now"), (2, "Please add 9 and 8 now"), (3, "What is the capital of Spain? Hm")]
    assert _leaks(spark, docs, items) == {(1, 2), (3, 3)}
    docs, items = (spark.createDataFrame(x, f"{k}_id long, text string") for x, k in ((docs, "doc"), (items, "item")))
    rows = op2_templates.template_leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.verbatim) for r in rows) == [(1, 2, True), (3, 3, False)]


def test_benchmark_passages_are_found(spark):
    docs, items = read(spark, "documents", "0.01"), read(spark, "benchmark", "0.01")

    def runs(text):
        own = [w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split()]
        return {tuple(own[i : i + 10]) for i in range(len(own) - 9)}

    of_item = {r.item_id: runs(r.text) for r in items.collect()}
    expected = set()
    for r in docs.collect():
        own = runs(r.text)
        expected |= {(r.doc_id, item) for item, other in of_item.items() if own & other}
    got = {(r.doc_id, r.item_id) for r in op2_templates.leaks(docs, items).collect()}
    assert got == expected and len(got) > 10


def test_digest(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    kept = op1_repeats.remove_repeats(docs).withColumn("d", F.sha2("kept_text", 256)).collect()
    assert {r.doc_id: r.d for r in kept} == {
        1: hashlib.sha256(b"a b").hexdigest(), 2: hashlib.sha256(b"").hexdigest()
    }


def test_templates_of_edge_rows(spark):
    """Clashing columns on both sides, NULLs, a very long text and a very long item."""
    docs = edge(spark)
    items = spark.createDataFrame(
        [(1, " ".join(PROSE[:30]), 1, "x"), (2, LONG[:6_000], 2, None), (3, None, 3, "y"), (None, "a b c d e f", 4, "z")],
        "item_id long, text string, doc_id long, template string",
    )
    rows = op2_templates.template_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (2, 1), (3, 1), (7, 2), (8, 2)}
    assert op2_templates.template_leaks(docs.limit(0), items).count() == 0
    assert op2_templates.template_leaks(docs, items.limit(0)).count() == 0
