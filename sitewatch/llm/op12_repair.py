"""Conversation structure repair: least-cost edits by Four-Russians block tables.

A conversation is a string of symbols, one for each row: its role initial and its first fault.
Edits turn it into roles ``(s?(ua)+)?``. What the rest of a conversation costs, from each state of
that pattern, is a vector of four costs; less their minimum, only a few dozen different ones
exist. For each of them and each block of ``BLOCK`` symbols, tables hold the vector before the
block and the cost added, so a conversation is processed by one look-up a block, from its end. To
trace the edits, blocks are expanded again from the vector at their right edge backward, and the
first edit, in ASCII order, of least cost is taken at each place: of all cheapest edits these are
the ASCII-least. A block traced once is remembered.

Rows are sorted over range partitions, so a long conversation lies in many tasks, as segments of
bounded size. A segment of such a conversation is a map of vectors, and of entry states for each
vector; only the maps of its segments come together, to find the vector and the state that each
segment begins with. Then all segments are traced for themselves.

``repair`` has one row for each segment with its edits and repaired rows, ``turns`` one for each
repaired row, ``report`` one for each conversation. Its SHA-256 of a conversation in several
segments is fed by one task in order, a segment at a time, as such a sum can't be split.

Defined cases: a NULL text, role or part of the key counts as one space; a NULL ``conv_id`` is a
conversation of its own; rows of equal turn are taken by role, then text, as far as the first
``SHOWN`` characters of each tell them apart, then by a hash of both; other columns are not read; an
empty table gives no row; conversations without rows have zeros and empty texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import own_columns, store

BLOCK = 4
SEGMENT_ROWS = 16_384
SEGMENT_BYTES = 4 << 20
SHOWN = 100

# The pattern's states: nothing yet, after s, after u, after a. Which role comes next, and then.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT_ROLE = np.array([0, 0, 1, 0])  # of (user, assistant)
_NEXT = np.array([USER, USER, ASSISTANT, USER])
_ROLES = ("user", "assistant")

DELETE, INSERT, KEEP, REROLE = b"DIKR"
_COST_DELETE, _COST_INSERT, _COST_REROLE, _COST_TRUNCATED = 2, 5, 1, 5

# Symbols: a row to be deleted; initials s, u, a and others; the same truncated; no row.
_MUST_DELETE, _NO_ROW, _N_SYMBOLS = 0, 9, 10
_FAR = 1 << 20

# The number of the vector after a conversation's last row.
END = 0

_SEGMENTS = (
    "conv_id long, part long, segment long, whole boolean, symbols binary, first string, last string, "
    "illegal long, role array<string>, text array<string>"
)
_REPAIRED = (
    "conv_id long, part long, segment long, whole boolean, illegal long, cost long, audit string, "
    "role array<string>, text array<string>"
)
_MAPS = (
    "conv_id long, part long, segment long, first string, last string, before array<int>, "
    "exit array<int>"
)
_LINKED = "part long, segment long, after int, state int, at_end boolean, borders long"
_DIGESTS = "conv_id long, illegal long, cost long, audit string, repaired_sha256 string"
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_CODES = {"s": 1, "u": 2, "a": 3}


def _kept_state(state: int, symbol: int) -> int | None:
    """The state after a row kept as it is, if the pattern lets it be."""
    initial = (symbol - 1) % 4
    if symbol in (_MUST_DELETE, _NO_ROW) or initial == 3:
        return None
    if initial == 0:
        return SYSTEM if state == START else None
    return int(_NEXT[state]) if _NEXT_ROLE[state] == initial - 1 else None


def _inserted(costs: np.ndarray) -> np.ndarray:
    """Costs if rows may be inserted first; two suffice to reach any state."""
    costs = costs.copy()
    for _ in range(2):
        costs = np.minimum(costs, costs[..., _NEXT] + _COST_INSERT)
    return costs


def _step(costs: np.ndarray, symbol: int) -> np.ndarray:
    """Costs from each state on before a row, from those after it."""
    if symbol == _NO_ROW:
        return costs
    out = costs + _COST_DELETE
    if symbol != _MUST_DELETE:
        extra = _COST_TRUNCATED if symbol > 4 else 0
        out = np.minimum(out, costs[_NEXT] + _COST_REROLE + extra)
        for state in range(4):
            kept = _kept_state(state, symbol)
            if kept is not None:
                out[state] = min(out[state], costs[kept] + extra)
    return _inserted(out)


def _expand(vector: np.ndarray, symbols, state: int) -> tuple[int, bytes]:
    """The state after a block and its edits, of cheapest ones the ASCII-least."""
    costs = [vector]
    for symbol in reversed(symbols):
        costs.append(_step(costs[-1], symbol))
    costs.reverse()
    edits = bytearray()
    for here, then, symbol in zip(costs, costs[1:], symbols):
        while symbol != _NO_ROW:
            extra = _COST_TRUNCATED if symbol > 4 else 0
            kept, target, cost = _kept_state(state, symbol), int(_NEXT[state]), here[state]
            if cost == _COST_DELETE + then[state]:
                edits.append(DELETE)
            elif cost == _COST_INSERT + here[target]:
                edits.append(INSERT)
                state = target
                continue
            elif kept is not None and cost == extra + then[kept]:
                edits.append(KEEP)
                state = kept
            else:
                edits.append(REROLE)
                state = target
            break
    return state, bytes(edits)


class Tables:
    """All vectors that occur, and what each block of symbols does to each of them."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = _inserted(np.array([0, _FAR, _FAR, 0]))
        vectors, numbers, one = [end], {tuple(end.tolist()): END}, []
        while len(one) < len(vectors):
            row = []
            for symbol in range(_N_SYMBOLS):
                costs = _step(vectors[len(one)], symbol)
                key = tuple((costs - costs.min()).tolist())
                if key not in numbers:
                    numbers[key] = len(vectors)
                    vectors.append(np.array(key))
                row.append(numbers[key])
            one.append(row)
        self.vectors, one, n = np.array(vectors), np.array(one), len(vectors)
        exits = np.array(
            [
                [[_expand(v, (x,), state)[0] for state in range(4)] for x in range(_N_SYMBOLS)]
                for v in self.vectors
            ]
        )
        # Of a block, the vector before it and the state after it for each state before it. Its
        # last symbol is the lowest digit of its code, and the first on the way back.
        self.before, self.exits = one, exits
        own, symbol = np.arange(n)[:, None, None, None], np.arange(_N_SYMBOLS)[:, None, None]
        for _ in range(block - 1):
            self.before = self.before[one].transpose(0, 2, 1).reshape(n, -1)
            after = exits[own, symbol, self.exits[one]]
            self.exits = after.transpose(0, 2, 1, 3).reshape(n, -1, 4)
        self._traced: dict[tuple[int, int, int], tuple[int, bytes]] = {}

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        """The blocks of a string of symbols; the first is filled up at its front."""
        short = -len(symbols) % self.block
        filled = np.concatenate([np.full(short, _NO_ROW), symbols]).reshape(-1, self.block)
        return filled @ _N_SYMBOLS ** np.arange(self.block - 1, -1, -1)

    def after(self, codes: np.ndarray, vector: int) -> list[int]:
        """The vector after each block, from the one after the last."""
        out = []
        for code in codes[::-1].tolist():
            out.append(vector)
            vector = int(self.before[vector, code])
        return out[::-1]

    def trace(self, codes: np.ndarray, vector: int, state: int, at_end: bool) -> bytes:
        """The edits of all blocks, with the inserts that end a conversation."""
        parts = []
        for key in zip(self.after(codes, vector), codes.tolist()):
            known = self._traced.get((*key, state))
            if known is None:
                symbols = [key[1] // _N_SYMBOLS**k % _N_SYMBOLS for k in range(self.block)][::-1]
                known = self._traced[*key, state] = _expand(self.vectors[key[0]], symbols, state)
            state, edits = known
            parts.append(edits)
        while at_end and state not in (START, ASSISTANT):
            parts.append(b"I")
            state = int(_NEXT[state])
        return b"".join(parts)

    def maps(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector after the blocks: that before them, and the state after each entry state."""
        vectors, steps = np.arange(len(self.vectors)), []
        for code in codes[::-1].tolist():
            steps.append((vectors, code))
            vectors = self.before[vectors, code]
        states = np.tile(np.arange(4), (len(self.vectors), 1))
        for after, code in reversed(steps):
            states = self.exits[after[:, None], code, states]
        return vectors, states


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut short, repeated or given another role, by a hash of their key."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = own_columns(rows, "conv_id", "turn", "role", "text")
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    role = F.when(fault == 4, F.lit("user")).otherwise(space("role"))
    text = (
        F.when(fault == 1, F.lit(""))
        .when(fault == 2, F.regexp_replace(space("text"), "[.!?]", ""))
        .otherwise(space("text"))
    )
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = rows.where(fault != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    )
    return out.drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """The stored rows with ``fault``: blank, duplicate, truncated or NULL.

    Each has a hash ``same`` of its role and text, and a ``number`` of its own. A row is a duplicate unless it is the first in its conversation with its role and text.
    """
    rows = own_columns(rows, "conv_id", "turn", "role", "text")
    rows = rows.fillna(" ", ["role", "text"])
    same = F.sha2(F.concat_ws("\0", F.length("role").cast("string"), "role", "text"), 256)
    numbered = rows.select("*", F.monotonically_increasing_id().alias("number"), same.alias("same"))
    # Stored, so that a task that runs again doesn't number rows anew.
    numbered = store(numbered, "op12-rows")
    place = F.struct("turn", "number")
    often = (
        numbered.groupBy("conv_id", "same")
        .agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("conv_id").alias("of"), F.col("same").alias("sum"), "earliest")
    )
    often = store(often, "op12-often")
    found = numbered.join(often, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("sum")), "left")
    end = F.right(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), F.lit(1))
    fault = (
        F.when(end == "", F.lit("blank"))
        .when(place > F.col("earliest"), F.lit("duplicate"))
        .when(~end.rlike("[.!?]"), F.lit("truncated"))
    )
    return found.select("conv_id", "turn", "role", "text", "same", "number", fault.alias("fault"))


def _rows_of(schema: str, kinds: list[pa.DataType]):
    """Makes a batch of rows of a schema."""
    names = [c.split()[0] for c in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names=names
        )

    return batch_of


_LONG, _BOOL, _TEXT, _TEXTS = pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.string())
_INTS = pa.list_(pa.int32())
_segments_of = _rows_of(
    _SEGMENTS, [_LONG, _LONG, _LONG, _BOOL, pa.binary(), _TEXT, _TEXT, _LONG, _TEXTS, _TEXTS]
)
_maps_of = _rows_of(_MAPS, [_LONG, _LONG, _LONG, _TEXT, _TEXT, _INTS, _INTS])
_repaired_of = _rows_of(_REPAIRED, [_LONG, _LONG, _LONG, _BOOL, _LONG, _LONG, _TEXT, _TEXTS, _TEXTS])
_digests_of = _rows_of(_DIGESTS, [_LONG, _LONG, _LONG, _TEXT, _TEXT])


def _illegal(initials: list[str]) -> int:
    return sum(pair not in _LEGAL for pair in zip(initials, initials[1:]))


def _cut(max_rows: int, max_bytes: int):
    """Sorted rows as segments of conversations; one that may go on in another task isn't whole."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, n_before, goes_on = TaskContext.get().partitionId(), 0, 0, False
        current, roles, texts, symbols, size = None, [], [], bytearray(), 0

        def segment(ended: bool) -> tuple:
            # The first conversation of a task may have begun before it.
            whole, initials = ended and n_before > 0 and not goes_on, [r[:1] for r in roles]
            edges = initials[0], initials[-1], _illegal(initials)
            return current, part, number, whole, bytes(symbols), *edges, roles, texts

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "fault"))
            for conv_id, role, text, fault in zip(*columns):
                ended = bool(roles) and conv_id != current
                if ended or len(roles) >= max_rows or size >= max_bytes:
                    out.append(segment(ended))
                    number, n_before, goes_on = number + 1, n_before + ended, not ended
                    roles, texts, symbols, size = [], [], bytearray(), 0
                if fault in ("blank", "duplicate"):
                    symbols.append(_MUST_DELETE)
                else:
                    symbols.append(_CODES.get(role[:1], 4) + 4 * (fault == "truncated"))
                current = conv_id
                roles.append(role)
                texts.append(text)
                size += len(role) + len(text)
            yield _segments_of(out)
        if roles:
            # Whether the last conversation of a task goes on is not known here.
            yield _segments_of([segment(False)])

    return cut


def _mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            out = []
            for r in batch.slice(at, 256).to_pylist():
                codes = tables().codes(np.frombuffer(r["symbols"], np.uint8).astype(np.int64))
                before, exits = tables().maps(codes)
                own = (r[c] for c in ("conv_id", "part", "segment", "first", "last"))
                out.append((*own, before.tolist(), exits.ravel().tolist()))
            yield _maps_of(out)


def _link(group):
    """The vector after each segment of a conversation, and the state before it."""
    group = group.sort_values(["part", "segment"])
    before, exits = group["before"].tolist(), group["exit"].tolist()
    vector, after = END, []
    for own in reversed(before):
        after.append(vector)
        vector = int(own[vector])
    after.reverse()
    state, states = START, []
    for own, vector in zip(exits, after):
        states.append(state)
        state = int(own[4 * vector + state])
    n, lasts = len(group), [None, *group["last"].tolist()]
    borders = [k > 0 and (a, b) not in _LEGAL for k, (a, b) in enumerate(zip(lasts, group["first"]))]
    out = group[["part", "segment"]].assign(after=after, state=states)
    return out.assign(at_end=[k == n - 1 for k in range(n)], borders=[int(x) for x in borders])


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            out = []
            for r in batch.slice(at, 256).to_pylist():
                codes = tables().codes(np.frombuffer(r["symbols"], np.uint8).astype(np.int64))
                audit = tables().trace(codes, r["after"], r["state"], r["at_end"])
                state, k, cost, roles, texts = r["state"], 0, 0, [], []
                for edit in audit:
                    symbol = r["symbols"][k] if k < len(r["symbols"]) else _NO_ROW
                    role, text, target = "", "", int(_NEXT[state])
                    if edit == INSERT:
                        role, cost = _ROLES[_NEXT_ROLE[state]], cost + _COST_INSERT
                    elif edit == DELETE:
                        k, cost = k + 1, cost + _COST_DELETE
                        continue
                    else:
                        role, text, k = r["role"][k], r["text"][k], k + 1
                        cost += _COST_TRUNCATED if symbol > 4 else 0
                        if edit == REROLE:
                            role, cost = _ROLES[_NEXT_ROLE[state]], cost + _COST_REROLE
                        else:
                            target = _kept_state(state, symbol)
                    state = target
                    roles.append(role)
                    texts.append(text)
                own = (r[c] for c in ("conv_id", "part", "segment", "whole"))
                illegal = r["illegal"] + r["borders"]
                out.append((*own, illegal, cost, audit.decode(), roles, texts))
            yield _repaired_of(out)


def repair(
    faulty: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """The segments of all conversations in ``faults``, in the order of ``part, segment``, stored.

    ``audit`` has their edits, ``role`` and ``text`` their rows after the edits, ``illegal`` the
    neighbouring roles before them that don't go together, ``whole`` if there is only this one.
    """
    # Short keys, as the planner takes a sample of them to the driver.
    shown = [F.substring(c, 1, SHOWN) for c in ("role", "text")]
    order = [F.col("conv_id"), F.col("turn"), *shown, F.col("same"), F.col("number")]
    ordered = faulty.repartitionByRange(*order).sortWithinPartitions(*order)
    segments = ordered.select("conv_id", "role", "text", "fault")
    segments = store(segments.mapInArrow(_cut(segment_rows, segment_bytes), _SEGMENTS), "op12-segments")
    own = segments.where(~F.col("whole")).select("conv_id", "part", "segment", "symbols", "first", "last")
    linked = own.mapInArrow(_mapped, _MAPS).groupBy("conv_id").applyInPandas(_link, _LINKED)
    found = segments.join(store(linked, "op12-links"), ["part", "segment"], "left")
    filled = found.select(
        "conv_id", "part", "segment", "whole", "symbols", "illegal", "role", "text",
        F.coalesce("after", F.lit(END)).alias("after"),
        F.coalesce("state", F.lit(START)).alias("state"),
        F.coalesce("at_end", F.lit(True)).alias("at_end"),
        F.coalesce("borders", F.lit(0)).alias("borders"),
    )
    return store(filled.mapInArrow(_edit, _REPAIRED), "op12-repaired")


def turns(repaired: DataFrame) -> DataFrame:
    """The repaired rows; those of a conversation in the order of ``part, segment, place``."""
    both = F.posexplode(F.arrays_zip("role", "text")).alias("place", "row")
    return repaired.select("conv_id", "part", "segment", both).select(
        "conv_id", "part", "segment", "place", "row.role", "row.text"
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation, from its segments one after the other."""
    current, begun = None, False
    for batch in batches:
        out = []
        for k in range(batch.num_rows):
            r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            if not begun or r["conv_id"] != current:
                if begun:
                    out.append((current, illegal, cost, "".join(audit), digest.hexdigest()))
                current, begun, empty = r["conv_id"], True, True
                illegal, cost, audit, digest = 0, 0, [], hashlib.sha256()
            illegal, cost = illegal + r["illegal"], cost + r["cost"]
            audit.append(r["audit"])
            lines = "\n".join(f"{a}:{b}" for a, b in zip(r["role"], r["text"]))
            if r["role"]:
                digest.update((lines if empty else "\n" + lines).encode())
                empty = False
        yield _digests_of(out)
    if begun:
        yield _digests_of([(current, illegal, cost, "".join(audit), digest.hexdigest())])


def report(ids: DataFrame, faulty: DataFrame, repaired: DataFrame) -> DataFrame:
    """One row for each of ``ids``: faults, cost, edits, and a digest of the repaired conversation."""
    count = lambda fault: F.count(F.when(F.col("fault") == fault, 1)).alias(fault)
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counted = faulty.groupBy("conv_id").agg(
        span.alias("gaps"), count("blank"), count("duplicate"), count("truncated")
    )
    whole = repaired.where("whole").mapInArrow(_digest, _DIGESTS)
    parts = repaired.where(~F.col("whole")).repartition("conv_id")
    parts = parts.sortWithinPartitions("conv_id", "part", "segment").mapInArrow(_digest, _DIGESTS)
    all_ = own_columns(ids, "conv_id").distinct()
    for found in (counted, whole, parts):
        all_ = all_.unionByName(found, allowMissingColumns=True)
    most = lambda c, none: F.coalesce(F.max(c), none).alias(c)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return all_.groupBy("conv_id").agg(
        *(most(c, F.lit(0).cast("long")) for c in numbers),
        most("audit", F.lit("")),
        most("repaired_sha256", F.sha2(F.lit(""), 256)),
    )


def op12_repair(spark, sf_dir: str) -> DataFrame:
    """``conversations`` damaged and repaired."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    faulty = store(faults(damaged(rows)), "op12-faults")
    return report(rows, faulty, repair(faulty))
