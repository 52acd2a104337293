import hashlib
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sitewatch.llm import op12_repair
from sitewatch.llm.common import prepare
from sitewatch.llm.op12_repair import END, START, Tables, tables
from tests.llm.edge import read

SPACES = " \t\n\x0b\f\r"
# Role initials and faults, as brute force sees them, for each symbol.
ROWS = [("u", "blank"), *((r, None) for r in "suax"), *((r, "truncated") for r in "suax")]
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def _least(rows):
    """Cost and audit of the cheapest edits, ties ASCII-least, by trying all."""

    @lru_cache(None)
    def best(k, last, inserts):
        out = [] if k < len(rows) or last not in ("", "a") else [(0, "")]
        if inserts < 2:
            out.append(_then(5, "I", best(k, NEXT[last], inserts + 1)))
        if k < len(rows):
            initial, fault = rows[k]
            out.append(_then(2, "D", best(k + 1, last, 0)))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if initial == NEXT[last] or initial == "s" and last == "":
                    out.append(_then(extra, "K", best(k + 1, initial, 0)))
                out.append(_then(1 + extra, "R", best(k + 1, NEXT[last], 0)))
        return min(out, default=(1 << 30, ""))

    def _then(cost, letter, rest):
        return cost + rest[0], letter + rest[1]

    return best(0, "", 0)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 8), max_size=40), st.sampled_from([1, 2, 3]))
def test_edits_are_the_least_of_all(symbols, block):
    own = Tables(block) if block < 3 else tables()
    codes = own.codes(np.array(symbols, np.int64))
    audit = own.trace(codes, END, START, True).decode()
    assert audit == _least(tuple(ROWS[k] for k in symbols))[1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 8), min_size=1, max_size=60), st.data())
def test_maps_of_parts_lead_to_the_same_edits(symbols, data):
    cuts = sorted(data.draw(st.sets(st.integers(0, len(symbols)), max_size=4)) | {0, len(symbols)})
    parts = [tables().codes(np.array(symbols[a:b], np.int64)) for a, b in zip(cuts, cuts[1:])]
    maps, vector, after = [tables().maps(p) for p in parts], END, []
    for before, _ in reversed(maps):
        after.insert(0, vector)
        vector = before[vector]
    state, audit = START, b""
    for k, (codes, vector, (_, exits)) in enumerate(zip(parts, after, maps)):
        audit += tables().trace(codes, vector, state, k == len(parts) - 1)
        state = exits[vector, state]
    assert audit == tables().trace(tables().codes(np.array(symbols)), END, START, True)


def test_vectors_are_few():
    assert len(tables().vectors) < 200 and tables().before.shape[1] == 10**op12_repair.BLOCK


def _hash(role, text):
    return hashlib.sha256(f"{len(role)}\0{role}\0{text}".encode()).hexdigest()


def _brute(rows):
    space = lambda x: " " if x is None else str(x)
    after = defaultdict(list)
    for conv_id, turn, role, text in rows:
        own = after[conv_id]
        h = zlib.crc32(f"{space(conv_id)}:{space(turn)}".encode()) % 20
        role, text = "user" if h == 4 else space(role), "" if h == 1 else space(text)
        text = re.sub("[.!?]", "", text) if h == 2 else text
        own += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = []
    for conv_id, own in after.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1][:100], r[2][:100], _hash(*r[1:])))
        turns, seen, marked = [r[0] for r in own if r[0] is not None], set(), []
        for _, role, text in own:
            end = text.rstrip(SPACES)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else None
            marked.append((role[:1], fault or ("truncated" if end not in ".!?" else None)))
            seen.add((role, text))
        n = lambda fault: sum(f == fault for _, f in marked)
        initials = [r for r, _ in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = _least(tuple(marked))
        k, last, lines = 0, "", []
        for edit in audit:
            role, text = ("", "") if edit == "I" else own[k][1:]
            k += edit != "I"
            if edit in "IR":
                role = {"u": "user", "a": "assistant"}[NEXT[last]]
            if edit != "D":
                last = role[:1]
                lines.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len({*turns}) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv_id, gaps, n("blank"), n("duplicate"), n("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def _edges(spark):
    rows = [
        (1, 0, "system", "You help."), (1, 1, "user", "Why?"), (1, 2, "assistant", "So."), (1, 2, "assistant", "So."),
        (1, None, "user", "x!"), (1, None, "assistant", None), (2, 5, None, None), (3, None, None, "a"),
        (None, 0, "user", "One."), (None, 1, "assistant", "Two."), (None, None, None, None),
        (4, 9, "tool", "a.b."), (4, 3, "", "Hm."), (4, 3, "user", "No end"), (5, 0, "user", "\t\x0b "),
        *((6, k // 2, "user", "Same.") for k in range(30)), *((k, 0, "user", "Hi.") for k in range(10, 60)),
        *((7, k, ("user", "assistant")[k % 2], f"Turn {k}." * (k % 7)) for k in range(50)),
        (8, 0, "user", "long " * 20_000), (8, 1, "assistant", "Ünï。"),
        *((9, 1, "user", "long " * 60 + f"{k}.") for k in range(9)),
    ]
    docs = [(*r, "b", 0, "x") for r in rows]
    return spark.createDataFrame(docs, "conv_id long, turn long, role string, text string, fault string, number int, symbols string")


@pytest.mark.parametrize("make", [_edges, lambda spark: read(spark, "conversations", "0.01")])
def test_same_as_brute_force(make, spark):
    prepare(spark)
    rows = make(spark)
    expected = _brute([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    faulty = op12_repair.faults(op12_repair.damaged(rows.repartition(5)))
    repaired = op12_repair.repair(faulty)
    got = op12_repair.report(rows, faulty, repaired).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == expected


def test_any_segments_give_the_same(spark):
    """Segments of one to three rows, so that every conversation is linked across many."""
    rows = _edges(spark)
    expected = _brute([tuple(r)[:4] for r in rows.collect()])
    faulty = op12_repair.faults(op12_repair.damaged(rows))
    for size in ({"segment_rows": 1}, {"segment_rows": 3}, {"segment_bytes": 40}):
        repaired = op12_repair.repair(faulty, **size)
        assert repaired.groupBy("conv_id").count().where("count > 9").count() > 0
        got = op12_repair.report(rows, faulty, repaired).select(COLUMNS).collect()
        assert sorted(map(tuple, got), key=repr) == expected
        lines = sorted(op12_repair.turns(repaired).where("conv_id = 7").collect(), key=lambda r: r[1:4])
        whole = "\n".join(f"{r.role}:{r.text}" for r in lines)
        assert hashlib.sha256(whole.encode()).hexdigest() == next(r[-1] for r in expected if r[0] == 7)


def test_query(spark):
    rows = read(spark, "conversations")
    got = op12_repair.op12_repair(spark, "/root/testdata/sf0.001").select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == _brute([tuple(r) for r in rows.collect()])
    assert rows.select("conv_id").distinct().count() == len(got)


def test_empty_table(spark):
    nothing = _edges(spark).limit(0)
    faulty = op12_repair.faults(op12_repair.damaged(nothing))
    repaired = op12_repair.repair(faulty)
    assert op12_repair.report(nothing, faulty, repaired).count() == 0
    assert op12_repair.turns(repaired).count() == 0
