"""Packing: concatenate all documents' ids and cut the stream into sequences of one length.

The first pass encodes each document and keeps its ids with the place it has in the stream of
its own partition. Partition totals, one row for each task, are summed up to the place at which
each partition begins; the second pass reads the stored ids and cuts them at the multiples of
the length. No document moves between machines. Sequences that lie in one task are whole there;
only those at its edges are handed over as boundary records and joined by their number. What a
sequence is made of goes with its ids, and the digests are those of the assembled sequences.

Defined cases: a NULL or empty text is the end id alone; documents with one id twice are packed
twice; a NULL ``doc_id`` is kept; an empty table gives no piece; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.llm.common import own_columns, store, text_slices
from sitewatch.llm.tokens import WORD_BPE, encoder

LENGTH = 4096
END_ID = 2

# Bytes of texts encoded at once, and parts of texts that a worker's encoder remembers.
SLICE_BYTES = 4 << 20
MOST_PARTS = 400_000

_STREAM = "part long, at long, doc_id long, ids binary, n long"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)
_OWN = "doc_id long, start long, length long, doc_tokens long, offset long"
_EDGES = f"sequence_id long, offset long, ids binary, pieces array<struct<{_OWN}>>"
_PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, n_ids long, ids binary"
)


def token_stream(
    docs: DataFrame, tokenizer: str = WORD_BPE, end_id: int = END_ID, folder: str | None = None
) -> DataFrame:
    """Each document's ids, as little-endian 32-bit integers, with its place in its partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer, folder, False, MOST_PARTS)
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi, _, _ in text_slices(batch.column("text"), SLICE_BYTES):
                ids, counts = encode_texts(batch.column("text").slice(lo, hi - lo))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype("<u4")
                n = counts + 1
                places = at + np.concatenate([[0], np.cumsum(n)])
                at = int(places[-1])
                bounds = (np.concatenate([[0], np.cumsum(n)]) * 4).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(hi - lo, part)),
                        pa.array(places[:-1]),
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.Array.from_buffers(
                            pa.binary(), hi - lo, [None, pa.py_buffer(bounds), pa.py_buffer(ids)]
                        ),
                        pa.array(n),
                    ],
                    names=["part", "at", "doc_id", "ids", "n"],
                )

    return own_columns(docs, "doc_id", "text").mapInArrow(encode, _STREAM)


def placed(stream: DataFrame) -> DataFrame:
    """The stored stream with each document's place among all ids."""
    totals = stream.groupBy("part").agg(F.sum("n").alias("total"))
    # One row of two numbers for each task of the first pass: small enough to broadcast.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return stream.join(F.broadcast(bases), "part").select(
        (F.col("base") + F.col("at")).alias("place"), "doc_id", "ids", "n"
    )


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """The batches in parts, as a worker holds what it takes from one as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _cut(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for place, doc_id, ids, n in zip(
                *(batch.column(c).to_pylist() for c in ("place", "doc_id", "ids", "n"))
            ):
                lo = 0
                while lo < n:
                    sequence, offset = divmod(place + lo, length)
                    hi = min(n, lo + length - offset)
                    piece = ids[4 * lo : 4 * hi]
                    rows.append(
                        (doc_id, lo, hi - lo, zlib.crc32(piece), n, sequence, offset, piece)
                    )
                    lo = hi
            names = [c.split()[0] for c in _PIECES.split(", ")]
            types = [pa.int64()] * 7 + [pa.binary()]
            columns = zip(*rows) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], names=names
            )

    return cut


def pieces(docs: DataFrame, length: int = LENGTH, **tokenizer) -> DataFrame:
    """Every piece of every document with its sequence, its place there and its ids."""
    stream = store(token_stream(docs, **tokenizer), "op9-stream")
    return placed(stream).mapInArrow(_cut(length), _PIECES)


def _join(length: int):
    """Pieces that lie side by side, joined up to whole sequences."""
    own = [c.split()[0] for c in _OWN.split(", ")]
    made = pa.list_(pa.struct([(c, pa.int64()) for c in own]))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, open_at, here, parts, made_of = None, 0, 0, [], []
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("sequence_id", "ids"))
            for sequence, ids, row in zip(*columns, batch.select(own).to_pylist()):
                if parts and (sequence, row["offset"]) != (open_id, here):
                    out.append((open_id, open_at, b"".join(parts), made_of))
                    parts = []
                if not parts:
                    open_id, open_at, here, made_of = sequence, row["offset"], row["offset"], []
                parts.append(ids)
                made_of.append(row)
                here += row["length"]
                if here == length:
                    out.append((open_id, open_at, b"".join(parts), made_of))
                    parts = []
            yield _edges(out)
        if parts:
            yield _edges([(open_id, open_at, b"".join(parts), made_of)])

    def _edges(rows):
        columns = zip(*rows) if rows else [[]] * 4
        types = (pa.int64(), pa.int64(), pa.binary(), made)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)],
            names=["sequence_id", "offset", "ids", "pieces"],
        )

    return join


def _whole(records: DataFrame, length: int, pad_id: int) -> DataFrame:
    """Sequences from records of them."""
    records = store(records, "op9-records")
    whole = records.where(F.length("ids") == 4 * length).select("sequence_id", "ids", "pieces")
    # A sequence has at most ``length`` records.
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "pieces")))
    joined = (
        records.where(F.length("ids") < 4 * length)
        .groupBy("sequence_id")
        .agg(ordered.alias("records"))
        .select(
            "sequence_id",
            F.aggregate("records", F.lit(b""), lambda a, r: F.concat(a, r["ids"])).alias("ids"),
            F.flatten("records.pieces").alias("pieces"),
        )
    )
    padding = int(pad_id).to_bytes(4, "little") * length
    return whole.unionByName(store(joined, "op9-joined")).select(
        "sequence_id",
        (F.length("ids") / 4).cast("long").alias("n_ids"),
        F.substring(F.concat("ids", F.lit(padding)), 1, 4 * length).alias("ids"),
        "pieces",
    )


def sequences(cut: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_ids, ids, pieces`` of all pieces, the ids padded to ``length``, stored.

    ``pieces`` says of which parts of which documents a sequence is made, in their order. A task
    joins the pieces it holds side by side; what is still short of a whole sequence is a boundary
    record, and only those are shuffled.
    """
    return _whole(cut.mapInArrow(_join(length), _EDGES), length, pad_id)


def packed(docs: DataFrame, length: int = LENGTH, pad_id: int = 0, **tokenizer) -> DataFrame:
    """The pieces of all sequences; a sequence's first one has its ``n_ids`` and padded ``ids``.

    So ``where("offset = 0")`` is the table of sequences, and a piece's ids are those of its
    sequence from ``offset`` on.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _PACKED.split(", ")]
        types = [pa.int64()] * 8 + [pa.binary()]
        for batch in _slices(batches):
            rows = []
            for r in batch.to_pylist():
                for p in r["pieces"]:
                    ids = r["ids"][4 * p["offset"] : 4 * (p["offset"] + p["length"])]
                    first = p["offset"] == 0
                    rows.append(
                        p
                        | {"ids_crc32": zlib.crc32(ids), "sequence_id": r["sequence_id"]}
                        | {"n_ids": r["n_ids"] if first else None, "ids": r["ids"] if first else None}
                    )
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names=names
            )

    stream = store(token_stream(docs, **tokenizer), "op9-stream")
    cut, join = _cut(length), _join(length)
    # Cut and joined by one worker: a second one for each task would be memory for nothing.
    records = placed(stream).mapInArrow(lambda batches: join(cut(batches)), _EDGES)
    return _whole(records, length, pad_id).mapInArrow(digest, _PACKED)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    """The digest of every piece of ``documents``, taken from the sequences."""
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("n_ids", "ids")
