import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitewatch.llm import op13_alignment
from sitewatch.llm.common import prepare
from sitewatch.llm.pieces import PIECE_BPE
from sitewatch.llm.tokens import BYTE_BPE, byte_entries, vocabulary
from tests.llm.edge import edge, read
from tests.llm.test_tokens import TRICKY

MORE = ["<s>x</s><0x0A>", "a▁b", "\x00a", "a 　 b", "   ", "x" * 3000, "é" * 50 + "<|endoftext|>"]


def _library():
    a = Tokenizer.from_file(vocabulary(BYTE_BPE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_BPE))


def _brute(rows):
    """Groups by sets of offsets, links by pairs of ends, counts over all rows."""
    a_model, b_model = _library()
    entries, found, counts = byte_entries(BYTE_BPE), [], Counter()
    for doc_id, text in rows:
        text = text or ""
        whole = (" " + text).encode()
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        a_bytes = [entries[k] for k in a]
        pieces = [b_model.id_to_piece(k) for k in b]
        b_bytes = [
            bytes([int(p[3:-1], 16)]) if b_model.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in zip(b, pieces)
        ]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append((doc_id, [], [], [], []))
            continue
        a_ends, b_ends = np.cumsum([*map(len, a_bytes)]).tolist(), np.cumsum([*map(len, b_bytes)]).tolist()
        cuts = sorted({*a_ends} & {*b_ends})
        groups, lo = [], 0
        for cut in cuts:
            groups.append(
                ([k for k, e in zip(a, a_ends) if lo < e <= cut], [k for k, e in zip(b, b_ends) if lo < e <= cut])
            )
            lo = cut
        by_end = dict(zip(b_ends, b))
        links = [(k, by_end[e]) for k, e in zip(a, a_ends) if e in by_end]
        counts.update(links)
        found.append((doc_id, a, b, groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        n_best = sum(counts[x] == best[x[1]] for x in links)
        sums = sum(counts[x] for x in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), n_best, sums, digest))
    return sorted(out, key=repr)


def _edges(spark):
    docs = edge(spark).select("doc_id", "text", "rows", "n_words")
    more = [(100 + k, text, 1, 2) for k, text in enumerate(TRICKY + MORE)]
    return docs.where("length(text) < 5000 or text is null").unionByName(spark.createDataFrame(more, docs.schema))


@pytest.mark.parametrize("make", [_edges, lambda spark: read(spark, "documents").where("length(text) < 3000")])
def test_groups_links_and_counts_are_those_of_brute_force(make, spark):
    prepare(spark)
    docs = make(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = op13_alignment.aligned(docs.repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == _brute(rows)


def test_any_slices_and_very_long_texts_give_the_same(spark):
    docs = edge(spark).repartition(1)
    one, two = (
        sorted(
            (r for row in op13_alignment.blocks(docs, slice_bytes=size).collect() for r in zip(*row[1:7])),
            key=repr,
        )
        for size in (1, 1 << 30)
    )
    assert one == two and len(one) == docs.count() and max(r[1] for r in one) > 5000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.data())
def test_pointers_end_at_the_next_common_end(sizes, data):
    a_ends = np.cumsum(sizes)
    inner = data.draw(st.sets(st.integers(1, int(a_ends[-1]))))
    b_ends = np.array(sorted(inner | {int(a_ends[-1])}))
    last, over = op13_alignment.terminals(a_ends, b_ends)
    common = np.array(sorted({*a_ends.tolist()} & {*b_ends.tolist()}))
    expected = common[np.searchsorted(common, np.concatenate([a_ends, b_ends]))]
    assert a_ends[last].tolist() == expected.tolist()
    assert b_ends[over[np.unique(last)]].tolist() == common.tolist()


def test_empty_table(spark):
    assert op13_alignment.aligned(edge(spark).limit(0)).count() == 0
