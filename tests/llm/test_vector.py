from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sitewatch.llm import op11_vector
from sitewatch.llm.common import prepare
from sitewatch.llm.op11_vector import Capacities, plan
from sitewatch.llm.tokens import WORD_BPE
from tests.llm.edge import edge, read
from tests.llm.test_tokens import _crc, _encoded


def _one_by_one(counts, capacities):
    """The lengths in each sequence when every piece is placed by itself."""
    bins = []
    for length in sorted(counts, reverse=True):
        size = np.array([length, 1, length * length])
        for _ in range(counts[length]):
            left = np.array([b[0] for b in bins]).reshape(-1, 3)
            fits = np.flatnonzero((left >= size).all(axis=1))
            if len(fits):
                scores = capacities.scores(size, left[fits])
                own = bins[fits[np.lexsort((fits, scores))[0]]]
            else:
                own = [capacities.limits.copy(), []]
                bins.append(own)
            own[0] -= size
            own[1].append(length)
    return [b[1] for b in bins]


def _planned(counts, capacities):
    bins, ranks = defaultdict(list), defaultdict(list)
    for length, rank, n, each, first, offset in plan(counts, capacities).tolist():
        ranks[length] += range(rank, rank + n)
        for k in range(n):
            bins[first + k // each].append((offset + k % each * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: [*range(n)] for k, n in counts.items()}
    for own in bins.values():  # no gap, no overlap
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
    return [[length for _, length in sorted(bins[k])] for k in sorted(bins)]


@settings(max_examples=300, deadline=None)
@given(
    st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25),
    st.sampled_from([None, 1, 3, 40]),
    st.sampled_from([None, 1600, 1700]),
    st.sampled_from(["norm", "dot"]),
    st.sampled_from([(1.0, 0.25, 0.25), (1.0, 0.0, 0.0), (0.2, 1.0, 0.7)]),
)
def test_plan_is_that_of_placing_one_by_one(counts, documents, attention, by, weights):
    capacities = Capacities(40, documents, attention, weights, by)
    bins = _planned(counts, capacities)
    assert bins == _one_by_one(counts, capacities)
    for own in bins:
        assert len(own) <= capacities.limits[1] and sum(x * x for x in own) <= capacities.limits[2]


def test_plans_stay_small_and_nearly_without_padding():
    random = np.random.default_rng(1)
    lengths = np.minimum(2048, np.exp(random.normal(5, 1.4, 2_000_000)).astype(int) + 1)
    counts = Counter(lengths.tolist())
    rows = plan(counts, Capacities())
    assert len(rows) < 40_000
    used = int((rows[:, 4] + -(-rows[:, 2] // rows[:, 3])).max())
    assert used <= 1.0005 * -(-int(lengths.sum()) // 2048)


def test_capacities_are_checked():
    for wrong in ({"tokens": 0}, {"documents": 0}, {"attention": -1}, {"by": "first"}):
        with pytest.raises(ValueError):
            Capacities(**wrong)


@pytest.mark.parametrize("make", [edge, lambda spark: read(spark, "documents")])
@pytest.mark.parametrize("capacities", [Capacities(256), Capacities(256, 3, 40_000)])
def test_sequences_hold_every_id_once(make, capacities, spark):
    prepare(spark)
    docs = make(spark).repartition(6)
    longest, rows = capacities.longest, docs.collect()
    found = op11_vector.packed(docs, capacities).collect()
    joined, n_pieces = defaultdict(list), 0
    for r in found:
        at = 0
        for p in r.pieces:
            assert p.offset == at and p.start == p.piece * longest
            assert p.length == min(longest, p.doc_tokens - p.start)
            at += p.length
            own = r.ids[4 * p.offset : 4 * at]
            joined[p.doc_id, p.doc_tokens].append((p.start, own))
            n_pieces += 1
        assert at == r.n_ids == len(r.ids) // 4 <= capacities.tokens
        assert len(r.pieces) <= capacities.limits[1]
        assert sum(p.length**2 for p in r.pieces) <= capacities.limits[2]
    assert len({r.sequence_id for r in found}) == len(found)
    encoded = [(r.doc_id, ids) for r, ids in zip(rows, _encoded(WORD_BPE, rows, 0))]
    expected = defaultdict(list)
    for doc_id, ids in encoded:
        for lo in range(0, len(ids), longest):
            expected[doc_id, len(ids)].append((lo, np.array(ids[lo : lo + longest], "<u4").tobytes()))
    assert {k: sorted(v) for k, v in joined.items()} == {k: sorted(v) for k, v in expected.items()}
    counts = Counter(p.length for r in found for p in r.pieces)
    assert len(found) == len(_one_by_one(counts, capacities))


def test_query(spark):
    rows = op11_vector.op11_vector(spark, "/root/testdata/sf0.001").collect()
    docs = read(spark, "documents").collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32, r.doc_tokens))
    for r, ids in zip(docs, _encoded(WORD_BPE, docs, 0)):
        expected = [
            (k, lo, len(ids[lo : lo + 2048]), _crc(ids[lo : lo + 2048]), len(ids))
            for k, lo in enumerate(range(0, len(ids), 2048))
        ]
        assert sorted(pieces.pop(r.doc_id)) == expected
    assert not pieces


def test_empty_table(spark):
    assert op11_vector.packed(edge(spark).limit(0)).count() == 0
