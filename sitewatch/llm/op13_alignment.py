"""Cross-tokenizer alignment: groups of two tokenizers' tokens by pointer jumping, links counted.

Tokens of both tokenizers lie over the same bytes. Every token points to the token, of either
side, that overlaps it and ends farthest to the right; at equal ends that is the first
tokenizer's, which then points to itself. Replacing all pointers by the pointers of what they
point to doubles their reach, so after a few rounds each token points to the last token of its
component, whose end is the offset where both sides end: it labels the group. Its partner of the
same end is linked with it.

How often a pair of ids is linked in the whole corpus is counted by Spark. A task numbers the
distinct pairs of each block of texts; only those, with their counts, are shuffled, and what is
known about them returns to the blocks, which stay in buckets where they were written.

Defined cases: a text that is NULL, empty, or not the joined bytes of either side's tokens has no
tokens and counts 0, its ``groups_sha256`` is empty; repeated rows are texts of their own and
count each time; a NULL ``doc_id`` is kept; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import own_columns, store, text_slices
from sitewatch.llm.pieces import PIECE_BPE, piece_encoder
from sitewatch.llm.tokens import BYTE_BPE, byte_entries, encoder
from sitewatch.session import materialise_buckets

_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_BLOCK = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, groups_sha256 array<string>, links array<int>, pair array<long>, "
    "times array<long>"
)
_OUT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)
_SIDE = 1 << 32

# Parts of texts that each of the two encoders of a worker remembers.
_MOST_PARTS = 200_000


class Entries:
    """The bytes behind all ids of a vocabulary, and the ids as decimal digits."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self._starts = np.cumsum(self.lengths) - self.lengths
        self._data = np.frombuffer(b"".join(entries), np.uint8)
        written = [b"%d" % k for k in range(len(entries))]
        self.width = max(map(len, written), default=1)
        self.n_digits = np.array([len(x) for x in written], np.int64)
        padded = b"".join(x.ljust(self.width + 1) for x in written)
        self.digits = np.frombuffer(padded, np.uint8).reshape(-1, self.width + 1)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        upto = np.cumsum(lengths)
        places = np.repeat(self._starts[ids] - upto + lengths, lengths)
        return self._data[places + np.arange(len(places))]


@lru_cache(maxsize=2)
def _entries(folder: str | None) -> tuple[Entries, Entries]:
    return Entries(byte_entries(BYTE_BPE, folder)), Entries(piece_encoder(PIECE_BPE, folder).entries)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last token of each token's component, and the B token over each A token's last byte.

    Both sides cover the same bytes without gaps. A tokens come first in the numbering of tokens.
    """
    n = len(a_ends)
    a_starts = np.concatenate([[0], a_ends[:-1]]) if n else a_ends
    b_starts = np.concatenate([[0], b_ends[:-1]]) if n else b_ends
    over_a = np.searchsorted(b_starts, a_ends) - 1
    over_b = np.searchsorted(a_starts, b_ends) - 1
    points_to = np.concatenate([np.where(b_ends[over_a] > a_ends, n + over_a, np.arange(n)), over_b])
    while True:
        farther = points_to[points_to]
        if np.array_equal(farther, points_to):
            return points_to, over_a
        points_to = farther


class Alignment:
    """The groups and links of some texts' tokens; the texts lie one after the other."""

    def __init__(self, a: np.ndarray, b: np.ndarray, entries: tuple[Entries, Entries]):
        self.a, self.b, self.entries = a, b, entries
        self.a_ends = np.cumsum(entries[0].lengths[a])
        self.b_ends = np.cumsum(entries[1].lengths[b])
        last, over = terminals(self.a_ends, self.b_ends)
        self.last_a = np.flatnonzero(last[: len(a)] == np.arange(len(a)))
        self.last_b = over[self.last_a]
        self.a_group = np.searchsorted(self.last_a, last[: len(a)])
        self.b_group = np.searchsorted(self.last_a, last[len(a) :])

    def links(self) -> np.ndarray:
        """The pair of ids of each link, in order: tokens of both sides that end together."""
        return self.a[self.last_a].astype(np.int64) * _SIDE + self.b[self.last_b]

    def written(self) -> tuple[np.ndarray, np.ndarray]:
        """``a,a|b;`` for each group, and where each one ends."""
        before_a = np.concatenate([[0], self.last_b + 1])[self.a_group]
        place_a = np.arange(len(self.a)) + before_a
        place_b = np.arange(len(self.b)) + self.last_a[self.b_group] + 1
        width = max(e.width for e in self.entries) + 1
        n = len(self.a) + len(self.b)
        out, sizes = np.zeros((n, width), np.uint8), np.zeros(n, np.int64)
        sides = (place_a, self.a, self.last_a, b"|"), (place_b, self.b, self.last_b, b";")
        for entries, (places, ids, lasts, mark) in zip(self.entries, sides):
            digits = entries.digits[ids]
            signs = np.full(len(ids), ord(","), np.uint8)
            signs[lasts] = ord(mark)
            digits[np.arange(len(ids)), entries.n_digits[ids]] = signs
            out[places, : digits.shape[1]] = digits
            sizes[places] = entries.n_digits[ids] + 1
        ends = np.cumsum(sizes)
        text = out[np.arange(width) < sizes[:, None]]
        return text, ends[place_b[self.last_b]]


def _slice(texts: pa.Array, folder: str | None):
    """The columns of some texts, one number or text for each, and the pairs of all their links."""
    entries = _entries(folder)
    spaced = pa.compute.binary_join_element_wise(
        pa.scalar("", pa.large_string()), texts.fill_null(""), pa.scalar(" ", pa.large_string())
    )
    a, n_a = encoder(BYTE_BPE, folder, True, _MOST_PARTS)(spaced)
    _, _, data, offsets = next(text_slices(spaced, 1 << 62))
    b, n_b, same = piece_encoder(PIECE_BPE, folder)(data, offsets)
    a = a.astype(np.int64)
    sizes = np.diff(offsets)
    a_upto = np.concatenate([[0], np.cumsum(entries[0].lengths[a])])
    a_sizes = np.diff(a_upto[np.concatenate([[0], np.cumsum(n_a)])])
    same &= (sizes > 1) & (a_sizes == sizes)
    other = entries[0].joined(a[np.repeat(same, n_a)]) != data[np.repeat(same, sizes)]
    same[np.repeat(np.flatnonzero(same), sizes[same])[other]] = False
    a, b = a[np.repeat(same, n_a)], b[np.repeat(same, n_b)]
    n_a, n_b = n_a * same, n_b * same
    aligned = Alignment(a, b, entries)
    first = np.searchsorted(aligned.last_a, np.concatenate([[0], np.cumsum(n_a)]))
    n_groups = np.diff(first)
    text, ends = aligned.written()
    ends = np.concatenate([[0], ends])[first]
    view = memoryview(text)
    digests = [
        hashlib.sha256(view[lo : hi - 1]).hexdigest() if hi > lo else ""
        for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())
    ]
    return (n_a, n_b, n_groups, n_groups, digests), aligned.links()


def blocks(docs: DataFrame, folder: str | None = None, slice_bytes: int = 1 << 20) -> DataFrame:
    """One row for each Arrow batch of documents: their counts, and their links by numbers of pairs."""
    names = [c.split()[0] for c in _BLOCK.split(", ")]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            texts = batch.column("text").cast(pa.large_string())
            columns, links = [], [np.zeros(0, np.int64)]
            for lo, hi, _, _ in text_slices(texts, slice_bytes):
                own, pairs = _slice(texts.slice(lo, hi - lo), folder)
                columns.append(own)
                links.append(pairs)
            if not columns:
                continue
            pair, number, times = np.unique(
                np.concatenate(links), return_inverse=True, return_counts=True
            )
            *counts, digests = zip(*columns)
            lists = [
                batch.column("doc_id"),
                *(pa.array(np.concatenate(c)) for c in counts),
                pa.array([d for own in digests for d in own], pa.string()),
                pa.array(number.astype(np.int32)),
                pa.array(pair),
                pa.array(times),
            ]
            block = pa.array([part << 32 | k], pa.int64())
            rows = [pa.ListArray.from_arrays([0, len(x)], x) for x in lists]
            yield pa.RecordBatch.from_arrays([block, *rows], names=names)

    return own_columns(docs, "doc_id", "text").mapInArrow(align, _BLOCK)


def linked(stored: DataFrame) -> DataFrame:
    """``pair, a, b, times, best``: how often ids are linked; whether none is with ``b`` more often."""
    own = stored.select(F.explode(F.arrays_zip("pair", "times")).alias("x")).select("x.*")
    counted = store(own.groupBy("pair").agg(F.sum("times").alias("times")), "op13-pairs")
    counted = counted.select(
        "pair", F.shiftright("pair", 32).alias("a"), (F.col("pair") % _SIDE).alias("b"), "times"
    )
    # One row for each entry of a vocabulary: small enough to broadcast.
    most = counted.groupBy("b").agg(F.max("times").alias("most"))
    with_most = counted.join(F.broadcast(most), "b")
    return with_most.select("pair", "a", "b", "times", (F.col("times") == F.col("most")).alias("best"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _OUT.split(", ")]
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k] for c in batch.schema.names}
            numbers = row["links"].values.to_numpy()
            known = row["known"].values
            times, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if known is not None:
                times = known.field("times").to_numpy(zero_copy_only=False)
                best = known.field("best").to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(row["n_links"].values.to_numpy())])
            sums = (
                pa.array(np.diff(np.concatenate([[0], np.cumsum(x[numbers])])[ends]))
                for x in (best, times)
            )
            counts = (row[c].values for c in _COUNTS)
            yield pa.RecordBatch.from_arrays(
                [row["doc_id"].values, *counts, *sums, row["groups_sha256"].values], names=names
            )


def aligned(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Each document's groups and links, and how common its links are in all of ``docs``."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = materialise_buckets(blocks(docs, folder), "op13-blocks", buckets, "block")
    own = stored.select("block", F.posexplode("pair").alias("number", "pair"))
    known = store(linked(stored).select("pair", "times", "best"), "op13-linked")
    returned = (
        own.join(known, "pair")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("number", "times", "best"))).alias("known"))
    )
    links = stored.drop("pair", "times")
    return links.join(returned, "block", "left").mapInArrow(_sums, _OUT)


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    """The alignment of byte-level and piece tokens of ``documents``."""
    return aligned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
