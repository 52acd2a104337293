"""Best-fit packing in three dimensions: sequences of bounded tokens, documents and attention cost.

A document longer than a sequence is cut into whole sequences and a rest. Pieces are then placed
longest first, each into the open sequence that it fits best under every capacity: by the smallest
weighted norm of what is left there afterwards, or by the smallest weighted dot product of the
piece and what is left there before. A new sequence is opened only if it fits nowhere.

All that matters about a piece is its length, so the rule is run on the lengths' counts: at most
one number for each possible length, however many documents there are. Sequences in one state are
filled together, as an interval of sequence numbers; the outcome is that of placing the pieces one
by one. It says for each run of equally long pieces, by rank, where they go. Ranks come from a
prefix sum over the tasks' counts of each length, and the stored ids are joined with it in the
buckets where they lie; the ids move once, to be assembled.

The plan's size does not depend on the data: a sequence holds at most about ``sqrt(2 * length)``
different lengths, and each length leaves at most four more intervals open than before.

Defined cases: a NULL or empty text is the end id alone; documents with one id twice are packed
twice; a NULL ``doc_id`` is kept; an empty table gives no piece; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.llm.common import own_columns, store, text_slices
from sitewatch.llm.tokens import WORD_BPE, encoder
from sitewatch.session import materialise_buckets

LENGTH = 2048
END_ID = 0

# Bytes of texts encoded at once, and parts of texts that a worker's encoder remembers.
SLICE_BYTES = 4 << 20
MOST_PARTS = 400_000

_STREAM = (
    "part long, doc_id long, ids binary, n_tokens long, n_full long, full_rank long, "
    "rest long, rest_rank long"
)
_PIECES = (
    "sequence_id long, offset long, doc_id long, piece int, start long, length long, "
    "doc_tokens long, ids binary"
)
_OWN = "doc_id long, piece int, start long, length long, doc_tokens long, offset long"
_SEQUENCES = f"sequence_id long, n_ids long, ids binary, pieces array<struct<{_OWN}>>"
_DIGESTS = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
    "offset long, doc_tokens long"
)


@dataclass(frozen=True)
class Capacities:
    """What one sequence may hold, and how much each of the three counts in the choice.

    A piece costs the square of its length in attention, as no piece attends to another. No
    limits on documents and attention mean those that the tokens imply.
    """

    tokens: int = LENGTH
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25)
    by: str = "norm"

    def __post_init__(self):
        limits = [self.tokens, self.documents, self.attention]
        if any(limit is not None and limit < 1 for limit in limits):
            raise ValueError("every capacity has to be positive")
        if self.by not in ("norm", "dot"):
            raise ValueError("by has to be norm or dot")

    @property
    def limits(self) -> np.ndarray:
        return np.array(
            [self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], np.int64
        )

    @property
    def longest(self) -> int:
        """The longest piece that an empty sequence takes."""
        return min(self.tokens, math.isqrt(int(self.limits[2])))

    def scores(self, size: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The smaller, the better a piece fits what is left; for each row of ``left``."""
        share, rest = size / self.limits, (left - size if self.by == "norm" else left) / self.limits
        return ((rest * rest if self.by == "norm" else rest * share) * self.weights).sum(axis=1)


def plan(counts: dict[int, int], capacities: Capacities) -> np.ndarray:
    """Where pieces go: rows of length, first rank, pieces, pieces a sequence, first sequence, offset.

    Pieces of one row fill consecutive sequences, each its number of pieces from the offset on.
    """
    limits, rows, n_sequences = capacities.limits, [], 0
    first, number = np.zeros(0, np.int64), np.zeros(0, np.int64)
    left = np.zeros((0, 3), np.int64)
    for length in sorted(counts, reverse=True):
        size, rank, n = np.array([length, 1, length * length]), 0, counts[length]
        open_ = (left[:, 0] > 0) & (left[:, 1] > 0) & (left[:, 2] > 0)
        first, number, left = first[open_], number[open_], left[open_]
        room = (left // size).min(axis=1)
        fits = np.flatnonzero(room > 0)
        fits = fits[np.lexsort((first[fits], capacities.scores(size, left[fits])))]
        upto = np.cumsum(room[fits] * number[fits])
        fits = fits[: np.searchsorted(upto, n) + 1]
        # The last resort: a run of empty sequences.
        placed = int(upto[len(fits) - 1]) if len(fits) else 0
        if placed < n:
            each = int((limits // size).min())
            more = -(-(n - placed) // each)
            first = np.append(first, n_sequences)
            number = np.append(number, more)
            left = np.vstack([left, limits])
            room = np.append(room, each)
            fits = np.append(fits, len(first) - 1)
            n_sequences += more
        added = []
        for k in fits.tolist():
            each, own = int(room[k]), min(n - rank, int(room[k] * number[k]))
            rows.append((length, rank, own, each, first[k], limits[0] - left[k, 0]))
            rank += own
            whole, some = divmod(own, each)
            begins, before = int(first[k]), left[k].copy()
            parts = [(begins, whole, before - each * size), (begins + whole, min(some, 1), before - some * size)]
            used = whole + min(some, 1)
            parts.append((begins + used, int(number[k]) - used, before))
            parts = [p for p in parts if p[1]]
            first[k], number[k], left[k] = parts[0]
            added += parts[1:]
        if added:
            first = np.concatenate([first, [p[0] for p in added]])
            number = np.concatenate([number, [p[1] for p in added]])
            left = np.vstack([left, [p[2] for p in added]])
    return np.array(rows, np.int64).reshape(-1, 6)


def token_stream(
    docs: DataFrame,
    longest: int = LENGTH,
    tokenizer: str = WORD_BPE,
    end_id: int = END_ID,
    folder: str | None = None,
) -> DataFrame:
    """Each document's ids, and the ranks of its pieces among the equally long ones of its task."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, part = encoder(tokenizer, folder, False, MOST_PARTS), TaskContext.get().partitionId()
        seen = np.zeros(longest + 1, np.int64)
        for batch in batches:
            for lo, hi, _, _ in text_slices(batch.column("text"), SLICE_BYTES):
                ids, counts = encode_texts(batch.column("text").slice(lo, hi - lo))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                n = counts + 1
                # Two bytes an id, if they are enough for all of the tokenizer's.
                kind = np.dtype("<u2" if encode_texts.size <= 1 << 16 else "<u4")
                data, bounds = ids.astype(kind), np.concatenate([[0], np.cumsum(n)]) * kind.itemsize
                full, rest = np.divmod(n, longest)
                full_rank = seen[longest] + np.cumsum(full) - full
                rest_rank = _ranks(rest) + seen[rest]
                seen += np.bincount(rest, minlength=longest + 1)
                seen[longest] += full.sum()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(hi - lo, part)),
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.Array.from_buffers(
                            pa.binary(),
                            hi - lo,
                            [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)],
                        ),
                        *map(pa.array, (n, full, full_rank, rest, rest_rank)),
                    ],
                    names=[c.split()[0] for c in _STREAM.split(", ")],
                )

    return own_columns(docs, "doc_id", "text").mapInArrow(encode, _STREAM)


def _ranks(values: np.ndarray) -> np.ndarray:
    """How many equal values there are before each."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.searchsorted(ordered, ordered)
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - first
    return out


def _counted(stream: DataFrame, longest: int) -> DataFrame:
    """How many pieces of each length each task has."""
    sizes = F.array(
        F.struct(F.lit(longest).cast("long").alias("length"), F.col("n_full").alias("n")),
        F.struct(F.col("rest").alias("length"), F.lit(1).cast("long").alias("n")),
    )
    each = stream.select("part", F.explode(sizes).alias("x")).select("part", "x.*")
    each = each.where("length > 0 AND n > 0")
    return each.groupBy("part", "length").agg(F.sum("n").alias("n"))


def _cut(rows: np.ndarray, longest: int):
    """The pieces of documents with their places, as the plan's rows say."""
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    rows = rows[order]
    lengths, ranks = rows[:, 0], rows[:, 1]
    begins = np.searchsorted(lengths, np.arange(longest + 2))
    names = [c.split()[0] for c in _PIECES.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 3 + [pa.binary()]

    def place(length: int, rank: int) -> tuple[int, int]:
        lo, hi = begins[length], begins[length + 1]
        k = lo + int(np.searchsorted(ranks[lo:hi], rank, "right")) - 1
        _, first_rank, _, each, first, offset = rows[k].tolist()
        sequence, nth = divmod(rank - first_rank, each)
        return first + sequence, offset + nth * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                out = []
                for r in batch.slice(at, 128).to_pylist():
                    ids, n, full = r["ids"], r["n_tokens"], r["n_full"]
                    width = len(ids) // n
                    for k in range(full + (r["rest"] > 0)):
                        length = longest if k < full else r["rest"]
                        rank = r["full_at"] + k if k < full else r["rest_at"]
                        lo = k * longest
                        own = ids[width * lo : width * (lo + length)]
                        out.append((*place(length, rank), r["doc_id"], k, lo, length, n, own))
                columns = zip(*out) if out else [[]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names=names
                )

    return cut


def pieces(docs: DataFrame, capacities: Capacities = Capacities(), **tokenizer) -> DataFrame:
    """Every piece of every document with its sequence, its place there and its ids."""
    spark, longest = docs.sparkSession, capacities.longest
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = token_stream(docs, longest, **tokenizer)
    stream = materialise_buckets(stream, "op11-stream", buckets, "part")
    counted = store(_counted(stream, longest), "op11-lengths")
    # One row for each possible length.
    totals = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(totals, capacities)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = counted.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    bases = based.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("length", "base"))).alias("bases")
    )
    at = lambda length: F.coalesce(F.element_at("bases", length), F.lit(0))
    placed = stream.join(bases, "part").select(
        "doc_id", "ids", "n_tokens", "n_full", "rest",
        (at(F.lit(longest).cast("long")) + F.col("full_rank")).alias("full_at"),
        (at(F.col("rest")) + F.col("rest_rank")).alias("rest_at"),
    )
    return placed.mapInArrow(_cut(rows, longest), _PIECES)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = [c.split()[0] for c in _OWN.split(", ")]
    kinds = [pa.int32() if c == "piece" else pa.int64() for c in own]
    made_of = pa.list_(pa.struct(list(zip(own, kinds))))
    open_id, parts, made = None, [], []

    def batch_of(rows):
        columns = zip(*rows) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary(), made_of))],
            names=["sequence_id", "n_ids", "ids", "pieces"],
        )

    def whole():
        ids = b"".join(parts)
        return open_id, len(ids) // 4, ids, made

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            some, rows = batch.slice(at, 1024), []
            columns = (some.column(c).to_pylist() for c in ("sequence_id", "ids"))
            for sequence, ids, row in zip(*columns, some.select(own).to_pylist()):
                if sequence != open_id and parts:
                    rows.append(whole())
                    parts, made = [], []
                open_id = sequence
                if len(ids) == 2 * row["length"]:
                    ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                parts.append(ids)
                made.append(row)
            yield batch_of(rows)
    if parts:
        yield batch_of([whole()])


def sequences(cut: DataFrame) -> DataFrame:
    """``sequence_id, n_ids, ids, pieces``: little-endian 32-bit ids, and the parts they come from."""
    dealt = cut.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    return dealt.mapInArrow(_assemble, _SEQUENCES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _DIGESTS.split(", ")]
    kinds = [pa.int32() if c == "piece" else pa.int64() for c in names]
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = [
                p
                | {
                    "sequence_id": r["sequence_id"],
                    "ids_crc32": zlib.crc32(r["ids"][4 * p["offset"] : 4 * (p["offset"] + p["length"])]),
                }
                for r in batch.slice(at, 256).to_pylist()
                for p in r["pieces"]
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], kind) for c, kind in zip(names, kinds)], names=names
            )


def packed(docs: DataFrame, capacities: Capacities = Capacities(), **tokenizer) -> DataFrame:
    """The sequences of all documents."""
    return sequences(pieces(docs, capacities, **tokenizer))


def op11_vector(spark, sf_dir: str) -> DataFrame:
    """The digest of every piece of ``documents``, taken from the assembled sequences."""
    whole = packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return whole.mapInArrow(_digests, _DIGESTS)
