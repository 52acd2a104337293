"""Vectorised words, hashes and shared-folder helpers of the operators in this subpackage.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. That is ``[^\\x20\\x09-\\x0D]+`` on the UTF-8 bytes: those six never occur inside
a multi-byte character.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatch.session import materialise

SLICE_BYTES = 1 << 19
BATCH_BYTES = 8 << 20
_SPACES = [0x20, *range(0x09, 0x0E)]
_IS_WORD = np.ones(256, bool)
_IS_WORD[_SPACES] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files.

    The lineage ends there, so an executor that is lost afterwards costs nothing. The shuffle
    files behind it are removed once the driver's collector sees that nobody refers to them;
    a driver with little to do may not collect for hours, so it is asked to.
    """
    stored = materialise(df, label)
    df.sparkSession.sparkContext._jvm.System.gc()
    return stored


def text_slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` bytes: first row, end row, bytes, offsets of the rows.

    A longer text is a slice of its own. A NULL has no bytes.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    # Arrow leaves the buffer out when there is no byte at all.
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, whole[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grow_powers(n: int) -> None:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)


class Words:
    """The words of some texts: byte positions, the first word of each text, 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        data = _LOWER[data] if lower else data
        self.data, n = data, len(data)
        inside = _IS_WORD[data]
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        edges = offsets[(offsets > 0) & (offsets < n)]
        before[edges] = False
        after[edges - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        _grow_powers(n + 1)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[0][:n], out=prefix[1:])
        self.hashes = mix((prefix[self.ends] - prefix[self.starts]) * _powers[1][self.starts])

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def left(self) -> np.ndarray:
        """How many words of its text there are from each word on."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive word hashes; those past a text's end are the caller's."""
    size = max(len(hashes) - n + 1, 0)
    out = hashes[:size].copy()
    for k in range(1, n):
        out *= _STEP
        out += hashes[k : k + size]
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's ``bigint``."""
    return x.view(np.int64)


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that others cannot clash with those an operator adds."""
    return df.select(*[F.col(f"`{name}`") for name in names])


_LETTER, _DIGIT, _OTHER = range(3)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = _LETTER
_KIND[48:58] = _DIGIT
_ENDS_SENTENCE = np.zeros(256, bool)
_ENDS_SENTENCE[list(b".!?:\n")] = True


class Tokens:
    """Runs of letters and numbers of some texts, in lower case (A-Z, À-Þ), with 64-bit hashes.

    Bytes beyond ASCII count as letters; a point or comma between digits is part of the number.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n, kinds = len(data), _KIND[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        digit = kinds == _DIGIT
        mark = (data == ord(".")) | (data == ord(","))
        mark[1:] &= digit[:-1] & ~edge[1:n]
        mark[:-1] &= digit[1:] & ~edge[1:n]
        if n:
            mark[0] = mark[-1] = False
        kinds[mark] = _DIGIT
        new = edge[:n].copy()
        new[1:] |= kinds[1:] != kinds[:-1]
        inside = kinds != _OTHER
        self.starts = np.flatnonzero(new & inside)
        last = np.append(new[1:], True) if n else new
        self.ends = np.flatnonzero(last & inside) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.is_number = kinds[self.starts] == _DIGIT
        # The second byte of a letter from U+00C0 to U+00DE, and of its lower case.
        latin = np.zeros(n, bool)
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        capital = latin & (data >= 0x80) & (data <= 0x9E)
        small = latin & (data >= 0xA0) | (data >= ord("a")) & (data <= ord("z"))
        head = data[self.starts]
        upper = (head >= ord("A")) & (head <= ord("Z"))
        upper |= (head == 0xC3) & capital[np.minimum(self.starts + 1, max(n - 1, 0))]
        smalls = np.concatenate([[0], np.cumsum(small)])
        self.is_capitalised = upper & (smalls[self.ends] > smalls[self.starts])
        stops = np.concatenate([[0], np.cumsum(_ENDS_SENTENCE[data])])
        before = np.append(0, self.ends[:-1])[: len(self.starts)]
        self.is_initial = stops[self.starts] > stops[before]
        self.is_initial[self.first[:-1][self.first[:-1] < len(self.starts)]] = True
        _grow_powers(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        lower = _LOWER[data]
        lower[capital] += 0x20
        lower = lower.astype(np.uint64) + np.uint64(1)
        np.cumsum(lower * _powers[0][:n], out=self.prefix[1:])
        self.hashes = self.hash_of(self.starts, self.ends)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hash_of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of any byte runs, in lower case."""
        return mix((self.prefix[ends] - self.prefix[starts]) * _powers[1][starts])


def prepare(spark: SparkSession) -> None:
    """Set a session up for these operators.

    Python workers import the package from where the driver did, if nothing else lets them.
    Arrow batches have 8 MB at most, so that what a worker holds does not depend on how long
    the texts are.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in [*paths, *os.environ.get("PYTHONPATH", "").split(os.pathsep)]:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
