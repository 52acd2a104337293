"""Variable-order byte context trees over several classes, as flat tables for numpy.

Level k of a tree has a node for each run of k bytes seen in training; a node's context is its
run without the last byte. Bytes are first mapped to the symbols seen in training, so that a
node's children are one row of a table. Node 0 of every level stands for "not seen".
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import text_slices

_COUNTS = "class string, level int, gram long, n long"


def gram_counts(docs: DataFrame, order: int) -> DataFrame:
    """How often each class has each run of up to ``order`` + 1 bytes.

    ``docs`` has ``class`` and ``text``. Runs do not cross texts. A partition adds up its own
    runs before anything is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], list[pd.Series]] = {}
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                labels = np.array(batch.column("class").slice(lo, hi - lo).to_pylist(), object)
                of_byte = np.repeat(np.arange(hi - lo), np.diff(offsets))
                left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
                codes = np.zeros(len(data), np.uint64)
                for level in range(1, order + 2):
                    n = len(data) - level + 1
                    if n <= 0:
                        break
                    codes = (codes[:n] << np.uint64(8)) | data[level - 1 :].astype(np.uint64)
                    for label in set(labels):
                        mine = (left[:n] >= level) & (labels[of_byte[:n]] == label)
                        grams, n_each = np.unique(codes[mine], return_counts=True)
                        known = sums.setdefault((label, level), [])
                        known.append(pd.Series(n_each, grams.view(np.int64)))
                        if len(known) > 16:
                            known[:] = [pd.concat(known).groupby(level=0).sum()]
        for (label, level), parts in sums.items():
            total = pd.concat(parts).groupby(level=0).sum()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([label] * len(total), pa.string()),
                    pa.array(np.full(len(total), level, np.int32)),
                    pa.array(total.index.to_numpy(np.int64)),
                    pa.array(total.to_numpy(np.int64)),
                ],
                names=["class", "level", "gram", "n"],
            )

    counted = docs.select("class", "text").mapInArrow(count, _COUNTS)
    return counted.groupBy("class", "level", "gram").agg(F.sum("n").alias("n"))


class ContextTrees:
    """Code lengths, in bits, of texts under every class by prediction by partial matching.

    In a context seen n times with d different next bytes, a byte seen k times there has the
    probability k / (n + d); with d / (n + d) the coder escapes to the context shorter by a
    byte, and past the empty context every byte has 1 / 256. A context a class has never seen is
    passed over without cost. The statistics are frozen after training, so the whole escape path
    of every node is summed up beforehand and a byte costs one look-up for each level.

    With ``smoothed`` the trees are Markov models instead: a byte that was seen in a context also
    gets the share d / (n + d) of its probability in the shorter one (Witten-Bell smoothing).
    """

    def __init__(self, counts: pd.DataFrame, order: int, smoothed: bool = False):
        self.classes = sorted(counts["class"].unique())
        n_classes = len(self.classes)
        self.order = order
        index = {c: i for i, c in enumerate(self.classes)}
        used = np.sort(counts.loc[counts["level"] == 1, "gram"].unique()).astype(np.int64)
        self.symbols = np.zeros(256, np.int64)
        self.symbols[used] = np.arange(1, len(used) + 1)
        self.width = width = len(used) + 1
        self.children: list[np.ndarray] = []  # of level k: parent * width + symbol -> node
        self.bits: list[np.ndarray] = []  # of level k: node, class -> bits of its last byte
        self.escape: list[np.ndarray] = []  # of level k as a context: node, class -> bits

        # Level 0 has one node, the empty context, at number 1.
        parent_grams = np.zeros(1, np.uint64)
        parent_bits: np.ndarray | None = None
        for level in range(1, order + 2):
            at = counts[counts["level"] == level]
            codes = at["gram"].to_numpy(np.int64).view(np.uint64)
            grams, node = np.unique(codes, return_inverse=True)
            n = np.zeros((len(grams), n_classes))
            np.add.at(n, (node, at["class"].map(index).to_numpy(int)), at["n"].to_numpy(float))
            context = np.searchsorted(parent_grams, grams >> np.uint64(8))
            totals = np.zeros((len(parent_grams), n_classes))
            distinct = np.zeros((len(parent_grams), n_classes))
            np.add.at(totals, context, n)
            np.add.at(distinct, context, n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(totals > 0, np.log2((totals + distinct) / distinct), 0.0)
                own = np.log2((totals + distinct)[context] / n)
            if parent_bits is None:
                shorter = np.full((len(grams), n_classes), 8.0)
            else:
                # The node of the same run without its first byte, one level up.
                mask = np.uint64((1 << 8 * (level - 1)) - 1)
                shorter = parent_bits[np.searchsorted(parent_grams, grams & mask)]
            below = escape[context] + shorter
            if smoothed:
                with np.errstate(divide="ignore"):
                    own = -np.log2(np.exp2(-own) + np.exp2(-below))
            bits = np.where(n > 0, own, below)
            table = np.zeros((len(parent_grams) + 1) * width, np.int32)
            last = self.symbols[(grams & np.uint64(0xFF)).astype(np.int64)]
            table[(context + 1) * width + last] = np.arange(1, len(grams) + 1)
            self.children.append(table)
            nothing = np.zeros((1, n_classes))
            self.bits.append(np.concatenate([nothing, bits]).astype(np.float32))
            self.escape.append(np.concatenate([nothing, escape]).astype(np.float32))
            parent_grams, parent_bits = grams, bits

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each class."""
        n = len(data)
        out = np.zeros((len(offsets) - 1, len(self.classes)))
        if n == 0:
            return out
        symbols = self.symbols[data]
        nodes = [self.children[0][self.width + symbols]]
        starts = offsets[:-1][np.diff(offsets) > 0]
        is_start = np.zeros(n, bool)
        is_start[starts] = True
        for level in range(2, self.order + 2):
            # A run ends at each byte; its context ends at the byte before, one level up.
            context = np.zeros(n, np.int64)
            context[1:] = nodes[-1][:-1]
            context[starts] = 0
            nodes.append(self.children[level - 1][context * self.width + symbols])
        # At each byte: the deepest run that was seen, and what it takes to escape down to it.
        # Levels share one numbering for the look-up.
        base = np.cumsum([0, *[len(b) for b in self.bits[:-1]]])
        deepest = nodes[-1].astype(np.int64) + base[-1]
        open_ = np.flatnonzero(nodes[-1] == 0)
        extra: list[tuple[np.ndarray, np.ndarray]] = []
        for level in range(self.order, -1, -1):
            if not len(open_):
                break
            # ``open_`` has no run of ``level`` + 1; escape from its context of ``level`` bytes.
            if level == 0:
                bits = np.broadcast_to(self.escape[0][1] + np.float32(8), (len(open_), out.shape[1]))
                extra.append((open_, bits))
                deepest[open_] = 0
                break
            context = np.where(is_start[open_], 0, nodes[level - 1][open_ - 1])
            extra.append((open_, self.escape[level][context]))
            down = nodes[level - 1][open_]
            deepest[open_] = down + base[level - 1]
            open_ = open_[down == 0]
        table = getattr(self, "_all_bits", None)
        if table is None:
            table = self._all_bits = np.concatenate(self.bits)
        bits = table[deepest]
        for where, more in extra:
            bits[where] += more
        full = np.flatnonzero(np.diff(offsets) > 0)
        out[full] = np.add.reduceat(bits, offsets[:-1][full], axis=0, dtype=np.float64)
        return out
