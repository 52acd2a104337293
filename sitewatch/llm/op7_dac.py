"""Token ids as directly addressable codes, with random access to any id.

An id is split into chunks of eight bits. Level 0 holds the lowest chunk of every id, level k
the next chunk of those ids that need one. Bit i of a level's continuation bitmap says whether
its i-th id goes on in the next level; where it stands there is the number of set bits before,
found from a directory of counts every 512 bits. So one id is read by a few look-ups, and no
block is decoded for it.

A table is a Parquet folder in ascending ``doc_id`` order. A row is one segment, with the ids of
whole documents: ``part``, ``at`` (its place in the part), ``doc_ids``, ``counts``, ``codes``.
``codes`` is the image that ``DacReader`` opens; ``look_up`` finds any ids of the whole table, by
their place or, with ``places_of``, by document. Its layout, all little-endian: the number of ids
(8 bytes) and of levels (4), then for each level the number of its chunks (8), the chunks,
the bitmap in whole bytes, lowest bit first, and a 4-byte count for each 512 bits.

Defined cases: a NULL or empty text has only the end id; rows with one ``doc_id`` follow each
other in the order of a hash of their texts; a NULL ``doc_id`` comes first; an empty table has no segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewatch.llm.common import own_columns, text_slices
from sitewatch.llm.tokens import BYTE_BPE, SLICE_BYTES, encoder
from sitewatch.session import scratch_path

END_ID = 0
_RANK_BITS = 512

# Places for one row of the index, and for one opening of a segment.
_BLOCK = 1 << 20
_NEAR = 1 << 16

_SEGMENTS = (
    "part long, at long, n_ids long, doc_ids array<long>, counts array<long>, codes binary"
)
_DOCS = "part long, at long, doc_id long, n_tokens long, ids_crc32 long"


def pack(ids: np.ndarray) -> bytes:
    """The image of ``ids``."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        higher = rest >> np.uint32(8)
        more = higher > 0
        bitmap = np.packbits(more, bitorder="little")
        sums = np.add.reduceat(more, np.arange(0, len(more), _RANK_BITS)) if len(more) else []
        ranks = (np.cumsum(sums) - sums).astype("<u4") if len(more) else np.zeros(0, "<u4")
        levels.append(
            struct.pack("<q", len(rest))
            + rest.astype(np.uint8).tobytes()
            + bitmap.tobytes()
            + ranks.tobytes()
        )
        rest = higher[more]
        if not len(rest):
            break
    return struct.pack("<qi", len(ids), len(levels)) + b"".join(levels)


class DacReader:
    """Opens an image; ``reader[i]`` is one id, ``reader.all()`` are all."""

    def __init__(self, image: bytes):
        self.n, n_levels = struct.unpack_from("<qi", image)
        at, self._levels = 12, []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<q", image, at)
            sizes = (n, -(-n // 8), 4 * -(-n // _RANK_BITS))
            at += 8
            views = []
            for size, kind in zip(sizes, (np.uint8, np.uint8, np.dtype("<u4"))):
                views.append(np.frombuffer(image, kind, size // np.dtype(kind).itemsize, at))
                at += size
            self._levels.append(views)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, (chunks, bitmap, ranks) in enumerate(self._levels):
            value |= int(chunks[i]) << (8 * k)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // _RANK_BITS
            lo = block * _RANK_BITS // 8
            before = bitmap[lo : (i >> 3) + 1].copy()
            before[-1] &= (1 << (i & 7)) - 1
            i = int(ranks[block]) + int(np.bitwise_count(before).sum())
        return value

    def all(self) -> np.ndarray:
        values = np.zeros(self.n, np.uint32)
        at = np.arange(self.n)
        for k, (chunks, bitmap, _) in enumerate(self._levels):
            values[at] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            at = at[np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)]
        return values


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str = BYTE_BPE, end_id: int = END_ID,
    folder: str | None = None,
) -> None:
    """Encode ``docs`` and write their ids to ``path`` in ascending ``doc_id`` order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, part, at = encoder(tokenizer, folder), TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi, _, _ in text_slices(batch.column("text"), SLICE_BYTES):
                ids, counts = encode_texts(batch.column("text").slice(lo, hi - lo))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                doc_ids = batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                row = [part, at, len(ids), doc_ids, (counts + 1).tolist(), pack(ids)]
                at += len(ids)
                longs = pa.list_(pa.int64())
                types = [pa.int64()] * 3 + [longs, longs, pa.binary()]
                names = [c.split()[0] for c in _SEGMENTS.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, types)], names=names
                )

    # Rows of one id are dealt out by a hash of their text, too, so that a hot id is many parts'.
    keyed = own_columns(docs, "doc_id", "text").withColumn("__key", F.xxhash64("text"))
    (
        keyed.repartitionByRange("doc_id", "__key")
        .sortWithinPartitions("doc_id", "__key", "text")
        .drop("__key")
        .mapInArrow(encode, _SEGMENTS)
        .write.parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = DacReader(row["codes"]).all().astype("<u4")
                ends = np.cumsum(row["counts"])
                crcs = [
                    zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, row["counts"])
                ]
                n = np.array(row["counts"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), row["part"])),
                        pa.array(row["at"] + ends - n),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(n),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "at", "doc_id", "n_tokens", "ids_crc32"],
                )

    segments = spark.read.schema(_SEGMENTS).parquet(path)
    docs = segments.select("part", "at", "doc_ids", "counts", "codes").mapInArrow(decode, _DOCS)
    return docs.join(_bases(segments), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def _bases(segments: DataFrame) -> DataFrame:
    """The place at which each part begins, to be broadcast."""
    # One row of two numbers for each task that wrote; the parts are in doc_id order.
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return F.broadcast(bases)


def places_of(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``wanted (doc_id, nth)`` with the ``place`` of a document's nth id in the whole table.

    A document that is not there, or shorter, gives no row; of several with one id each does.
    """
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    ends = F.transform(
        F.sequence(F.lit(1), F.size("counts")),
        lambda k: F.aggregate(F.slice("counts", 1, k), F.lit(0).cast("long"), lambda a, n: a + n),
    )
    docs = segments.join(_bases(segments), "part").select(
        (F.col("base") + F.col("at")).alias("start"),
        F.explode(F.arrays_zip(F.col("doc_ids").alias("id"), F.col("counts").alias("n"), ends.alias("end"))).alias("d"),
    )
    docs = docs.select(F.col("d.id").alias("doc_id"), F.col("d.n").alias("n"), (F.col("start") + F.col("d.end") - F.col("d.n")).alias("start"))
    return (
        wanted.join(docs, "doc_id")
        .where((F.col("nth") >= 0) & (F.col("nth") < F.col("n")))
        .select("doc_id", "nth", (F.col("start") + F.col("nth")).alias("place"))
    )


def look_up(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """``place, id``: the id at each ``place`` of the whole table, NULL where there is none.

    Places are joined with the segments by blocks of ``_BLOCK`` places, so only the rows of an
    index move, and each wanted segment is opened, not decoded. Places of one segment are dealt out
    by their neighbourhoods, so a hot one is many tasks'.
    """
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    index = segments.join(_bases(segments), "part").where("n_ids > 0").select(
        "part", "at", "n_ids", (F.col("base") + F.col("at")).alias("start")
    )
    block = lambda place: F.floor(place / _BLOCK)
    last = F.col("start") + F.col("n_ids") - 1
    index = index.withColumn("block", F.explode(F.sequence(block(F.col("start")), block(last))))
    own = F.col("place") - F.col("start")
    asked = places.select("place").distinct().withColumn("block", block(F.col("place")))
    found = asked.join(index, "block").where((own >= 0) & (own < F.col("n_ids")))
    dealt = found.select("part", "at", "start", own.alias("nth")).groupBy(
        "part", "at", "start", F.floor(F.col("nth") / _NEAR).alias("near")
    ).agg(F.collect_list("nth").alias("nth"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = DacReader(row["codes"])
                ids = [reader[k] for k in row["nth"]]
                at = [row["start"] + k for k in row["nth"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int64()), pa.array(ids, pa.int64())], names=["place", "id"]
                )

    opened = dealt.join(segments.select("part", "at", "codes"), ["part", "at"])
    known = opened.select("start", "nth", "codes").mapInArrow(read, "place long, id long")
    return places.select("place").join(known, "place", "left")


def op7_dac(spark, sf_dir: str) -> DataFrame:
    """Write the ids of all ``documents`` and return what the files say of each document."""
    path = scratch_path(spark, "op7-tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_tokens(spark, path)
