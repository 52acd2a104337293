"""Near-duplicate documents by MinHash with tensored banding, confirmed on full sets.

Two collections of ``PIECES`` pieces, each piece ``ROWS`` minhashes, are computed for a document.
Every pair of a piece of the first and one of the second is a table key: 196 tables of six
minhashes from 84 instead of 1,176 of them. Two documents of similarity s meet in some table with
probability (1 - (1 - s^ROWS)^PIECES)^2, 0.9999 at 0.8; a half do at 0.44.

1. Documents with equal shingle sets are one class, found by a 128-bit fingerprint and the size,
   numbered by its first row. Copies end here, however many there are.
2. A class meets another only if they share a piece on both sides, so pieces that occur once are
   dropped before any pair is formed.
3. In each table bucket all members are compared with the most central one, the class whose
   pieces are the most frequent. The exact similarity comes from the full sets.
4. Components of the links found. A bucket whose members are all in one component is done, as a
   further link could not change it. Of the classes in others it is counted how many of their
   shingles any other component has at all: a class with too few for 80 percent has no further
   link. A heavily edited copy mostly goes this way, in linear time.
5. What is left is decided exactly. Of a class's shingles, put in one order for all, those of its
   own component first and then by how rare they are, two linked classes share one among the first
   20 percent. Classes that do are compared: pairs, where few share a shingle; where many do, blocks
   of them, by counts over lists of who has which shingle. Only links leave a block.

So no pair of rows is formed within a large group, and no pair that met in a bucket is left undecided.

Defined cases: a NULL text, or one without words, has no shingle, its own component and is kept;
a text with fewer words than a shingle is one shingle of its whole sequence; rows with one
``doc_id`` are compared as rows of their own, by their texts; a NULL ``doc_id`` is kept and has no
component; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatch.llm.common import Words, mix, ngrams, own_columns, signed, store, text_slices
from sitewatch.llm.components import components, merged

WORDS = 4
PIECES = 14
ROWS = 3
PERCENT = 80
BLOCK = 500_000
FEW = 50

_SIGNATURES = (
    "doc_id long, text_key long, n_shingles long, fp1 long, fp2 long, left array<long>, right array<long>"
)
_CELLS = 4 << 20


def _keyed(docs: DataFrame) -> DataFrame:
    return own_columns(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, words: int
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, one text after the other; their ends."""
    table = Words(data, offsets, lower=True)
    counts = table.counts
    grams = ngrams(table.hashes, words)
    out, sizes = [], np.zeros(len(counts), np.int64)
    for i, n in enumerate(counts):
        if n == 0:
            continue
        first = table.first[i]
        if n >= words:
            own = np.unique(grams[first : first + n - words + 1])
        else:
            own = mix(ngrams(table.hashes[first : first + n], n) + np.uint64(n))
        out.append(own)
        sizes[i] = len(own)
    flat = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def _seeds(n: int, tag: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tag))


def signatures(
    docs: DataFrame, words: int = WORDS, pieces: int = PIECES, rows: int = ROWS
) -> DataFrame:
    """Set size, fingerprint and the pieces of both collections of each document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_hashes = 2 * pieces * rows
        xors, factors = _seeds(n_hashes, 1), _seeds(n_hashes, 2) | np.uint64(1)
        tags = _seeds(2 * pieces, 3)
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                flat, ends = shingle_sets(data, offsets, words)
                n = np.diff(ends)
                full = np.flatnonzero(n > 0)
                starts = ends[:-1][full]
                prints = np.zeros((2, hi - lo), np.uint64)
                bands = np.zeros((hi - lo, 2 * pieces), np.uint64)
                if len(full):
                    for k, tag in enumerate((11, 12)):
                        prints[k, full] = np.add.reduceat(mix(flat + np.uint64(tag)), starts)
                    for k in range(n_hashes):
                        least = np.minimum.reduceat((flat ^ xors[k]) * factors[k], starts)
                        piece = k // rows
                        bands[full, piece] = mix(bands[full, piece] + least + tags[piece])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        batch.column("text_key").slice(lo, hi - lo),
                        pa.array(n),
                        pa.array(signed(prints[0])),
                        pa.array(signed(prints[1])),
                        _lists(bands[:, :pieces]),
                        _lists(bands[:, pieces:]),
                    ],
                    names=[c.split()[0] for c in _SIGNATURES.split(", ")],
                )

    return _keyed(docs).mapInArrow(sign, _SIGNATURES)


def _lists(rows: np.ndarray) -> pa.ListArray:
    bounds = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(bounds, signed(np.ascontiguousarray(rows).reshape(-1)))


def _members(classes: DataFrame) -> DataFrame:
    """``key, id, n, central`` of each table bucket with at least two classes."""
    sides = classes.select(
        "id",
        "n",
        F.explode(
            F.concat(
                F.transform("left", lambda x: F.struct(F.lit(0).alias("side"), x.alias("piece"))),
                F.transform("right", lambda x: F.struct(F.lit(1).alias("side"), x.alias("piece"))),
            )
        ).alias("p"),
    ).select("id", "n", "p.side", "p.piece")
    # Stored, here and below, as a join can only split a frequent key if both its sides come
    # from a shuffle.
    again = sides.groupBy("side", "piece").agg(F.count("*").alias("often")).where("often > 1")
    again = store(again, "op8-again")
    shared = (
        sides.join(again, ["side", "piece"])
        .groupBy("id", "n")
        .agg(  # at most two collections of pieces
            F.collect_list(F.when(F.col("side") == 0, F.col("piece"))).alias("left"),
            F.collect_list(F.when(F.col("side") == 1, F.col("piece"))).alias("right"),
            F.sum("often").alias("central"),
        )
    )
    keyed = shared.select("id", "n", "central", "right", F.explode("left").alias("a")).select(
        "id", "n", "central", "a", F.explode("right").alias("b")
    )
    keyed = store(keyed.select(F.xxhash64("a", "b").alias("key"), "id", "n", "central"), "op8-keys")
    busy = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    busy = store(busy, "op8-busy")
    return keyed.join(busy, "key").drop("size")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs (a, b)`` with the sizes of their intersection and union."""

    def common(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in columns:
            both = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True))
                for x, y in zip(left.to_pylist(), right.to_pylist())
            ]
            yield pa.array(both, pa.int64())

    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    joined = joined.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    sized = joined.withColumn("both", F.arrow_udf(common, "long")("sa", "sb"))
    any_ = (F.length("sa") + F.length("sb")) / 8 - F.col("both")
    return sized.select(
        "a",
        "b",
        (F.col("both") / any_).alias("similarity"),
        (100 * F.col("both") >= percent * any_).alias("linked"),
    )


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """The full sets of the classes ``ids (id, doc_id, text_key)``, as sorted 64-bit hashes."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                flat, ends = shingle_sets(data, offsets, words)
                bounds = (ends * 8).astype(np.int32)
                own = pa.Array.from_buffers(
                    pa.binary(), hi - lo, [None, pa.py_buffer(bounds), pa.py_buffer(flat)]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), own], names=["id", "set"]
                )

    named = _keyed(docs).join(ids, ["doc_id", "text_key"])
    return named.mapInArrow(full, "id long, set binary").dropDuplicates(["id"])


def _could_link(a: str, b: str, percent: int):
    """No pair whose sizes differ by more can reach the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """``id, n, component`` of the classes in buckets that hold several components."""
    placed = members.join(found, "id", "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("component")
    )
    mixed = (
        placed.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo < hi")
    )
    return placed.join(mixed.select("key"), "key").select("id", "n", "component").distinct()


def _unpacked(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``id, n, component, shingle`` of all shingles of the classes."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                own = [np.frombuffer(x, np.int64) for x in part.column("set").to_pylist()]
                times = [len(x) for x in own]
                named = (part.column(c).to_numpy() for c in ("id", "n", "component"))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.repeat(c, times)) for c in named), pa.array(np.concatenate(own))],
                    names=["id", "n", "component", "shingle"],
                )

    return sets.join(classes, "id").mapInArrow(
        unpack, "id long, n long, component long, shingle long"
    )


def _common(shingles: DataFrame) -> DataFrame:
    """The shingles that several components have, with the number of classes."""
    counted = shingles.groupBy("shingle").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("often")
    )
    return counted.where("lo < hi").select("shingle", "often")


def _able(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The classes of whose shingles enough are in other components, too.

    A class of another component has no more than these in common with one.
    """
    shingles = _unpacked(classes, sets)
    shared = shingles.join(_common(shingles).select("shingle"), "shingle")
    counted = shared.groupBy("id", "n", "component").agg(F.count("*").alias("shared"))
    return counted.where(100 * F.col("shared") >= percent * F.col("n")).drop("shared")


def _first_shingles(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The first shingles of each class, of which linked classes share one; see step 5."""
    shingles = store(_unpacked(classes, sets), "op8-shingles")
    common = store(_common(shingles), "op8-common")
    ordered = Window.partitionBy("id").orderBy("often", "shingle")
    whole = Window.partitionBy("id")
    # At most a document's shingles are in one group.
    ranked = shingles.join(common, "shingle").select(
        "id", "n", "component", "shingle",
        F.row_number().over(ordered).alias("nth"), F.count("*").over(whole).alias("shared"),
    )
    own = F.col("n") - F.col("shared")
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return ranked.where(F.col("nth") <= first - own).drop("nth", "shared")


def _compare(percent: int):
    """Links of two blocks of classes, one for each pair of components."""

    def compare(key, table):
        i, j = key[1].as_py(), key[2].as_py()
        blocks = table.column("own").to_numpy()
        ids, labels = table.column("id").to_numpy(), table.column("component").to_numpy()
        shingles = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        n = np.array([len(x) for x in shingles])
        values, codes = np.unique(np.concatenate(shingles), return_inverse=True)
        row = np.repeat(np.arange(len(n)), n)
        ends = np.concatenate([[0], np.cumsum(n)])
        right = np.flatnonzero(blocks == j)
        # Who of the right block has a shingle: a run of ``holders`` for each.
        nth = np.full(len(n), -1)
        nth[right] = np.arange(len(right))
        of_right = np.flatnonzero(nth[row] >= 0)
        of_right = of_right[np.argsort(codes[of_right], kind="stable")]
        holders = nth[row[of_right]]
        begins = np.searchsorted(codes[of_right], np.arange(len(values) + 1))
        step = max(1, _CELLS // max(len(right), 1))
        seen, out = set(), []
        left = np.flatnonzero(blocks == i)
        for at in range(0, len(left), step):
            part = left[at : at + step]
            both = np.zeros((len(part), len(right)), np.int32)
            for k, x in enumerate(part):
                own = codes[ends[x] : ends[x + 1]]
                size = begins[own + 1] - begins[own]
                upto = np.cumsum(size)
                runs = np.repeat(begins[own] - upto + size, size) + np.arange(upto[-1])
                both[k] = np.bincount(holders[runs], minlength=len(right))
            linked = 100 * both >= percent * (n[part][:, None] + n[right][None, :] - both)
            linked &= labels[part][:, None] != labels[right][None, :]
            for x, y in zip(*np.nonzero(linked)):
                a, b = part[x], right[y]
                pair = (min(labels[a], labels[b]), max(labels[a], labels[b]))
                if pair not in seen:
                    seen.add(pair)
                    out.append((int(ids[a]), int(ids[b])))
        return pa.table(
            {
                "a": pa.array([x for x, _ in out], pa.int64()),
                "b": pa.array([y for _, y in out], pa.int64()),
            }
        )

    return compare


def _late_links(
    members: DataFrame, found: DataFrame, sets: DataFrame, percent: int, block: int, few: int
) -> DataFrame:
    """Links ``(a, b)`` between components that met in a bucket: at least one for each two linked."""
    classes = store(_open(members, found), "op8-open")
    # Twice, as what the first pass rules out no longer shares anything with the others.
    for _ in range(2):
        classes = store(_able(classes, sets, percent), "op8-able")
    first = store(_first_shingles(classes, sets, percent), "op8-first")
    # The same classes often share several shingles: one of these is enough.
    who = F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("who")
    groups = first.groupBy("shingle").agg(
        F.count("*").alias("size"), who, F.min("component").alias("lo"),
        F.max("component").alias("hi"), F.sum("n").alias("total"),
    )
    groups = groups.where("lo < hi").groupBy("size", "who", "total")
    groups = store(groups.agg(F.min("shingle").alias("shingle")), "op8-groups")
    joined = first.join(groups, "shingle")

    small = store(joined.where(F.col("size") <= few).select("shingle", "id", "n", "component"), "op8-few")
    a, b = small.alias("a"), small.alias("b")
    met = a.join(b, F.col("a.shingle") == F.col("b.shingle")).where(
        (F.col("a.component") < F.col("b.component")) & _could_link("a.n", "b.n", percent)
    )
    pairs = met.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    linked = _verify(store(pairs, "op8-few-pairs"), sets, percent).where("linked").select("a", "b")

    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    large = joined.where(F.col("size") > few).withColumn(
        "blocks", F.ceil(F.col("total") / block).cast("int")
    )
    dealt = large.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    dealt = dealt.join(sets, "id").select(
        "shingle", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "id", "component", "set",
    )
    compared = dealt.groupBy("shingle", "i", "j").applyInArrow(_compare(percent), "a long, b long")
    return linked.union(compared)


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    pieces: int = PIECES,
    rows: int = ROWS,
    percent: int = PERCENT,
    block: int = BLOCK,
    few: int = FEW,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_key, stays, many`` of every document.

    ``component_id`` is the smallest ``doc_id`` of the component, which ``kept`` says it has.
    Rows that share it are told apart by ``text_key``, the hash of their text: of a component
    only those with the smallest ``(doc_id, text_key)`` have ``stays``. ``many`` says whether it
    may have more than one row.
    """
    numbered = signatures(docs, words, pieces, rows).withColumn("row", F.monotonically_increasing_id())
    signed_docs = store(numbered, "op8-signatures")
    grouped = (
        signed_docs.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("fp1", "fp2", "n_shingles")
        .agg(
            F.min("row").alias("id"),
            F.min(F.struct("doc_id", "text_key")).alias("of"),
            F.count("*").alias("copies"),
            F.first("left").alias("left"),
            F.first("right").alias("right"),
        )
    )
    grouped = store(grouped, "op8-classes")
    classes = grouped.select("id", F.col("n_shingles").alias("n"), "left", "right")
    members = store(_members(classes), "op8-members")

    # The most central member of each bucket, compared with all others.
    centre = members.groupBy("key").agg(
        F.max(F.struct("central", F.negative("id").alias("id"), F.col("n").alias("m"))).alias("c")
    )
    centre = centre.select("key", F.negative("c.id").alias("a"), F.col("c.m").alias("m"))
    centre = store(centre, "op8-centre")
    spokes = members.join(centre, "key").where(F.col("id") != F.col("a"))
    near = spokes.where(_could_link("n", "m", percent))
    pairs = near.select("a", F.col("id").alias("b")).distinct()
    ids = members.select("id").distinct().join(grouped.select("id", "of.*"), "id")
    sets = store(_sets(docs, ids, words), "op8-sets")
    compared = store(_verify(pairs, sets, percent), "op8-compared")
    links = compared.where("linked").select("a", "b")
    found = components(links)

    late = store(_late_links(members, found, sets, percent, block, few), "op8-late")
    final = found if late.isEmpty() else merged(found, late)

    copies = grouped.where("copies > 1").select("fp1", "fp2", "n_shingles", "id")
    own = signed_docs.drop("left", "right").join(copies, ["fp1", "fp2", "n_shingles"], "left")
    own = own.withColumn("many", F.col("doc_id").isNotNull() & F.col("id").isNotNull())
    own = own.withColumn("id", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "row")))
    placed = own.join(final, "id", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("component", "id").alias("component"),
        (F.col("many") | F.col("component").isNotNull()).alias("many"),
    )
    placed = store(placed, "op8-placed")
    # Most documents are alone, and know their component's smallest id.
    firsts = placed.where("many").groupBy("component").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first")
    )
    together = placed.where("many").join(store(firsts, "op8-firsts"), "component").select(
        "doc_id", "text_key", "n_shingles", F.col("first.doc_id").alias("component_id"),
        (F.struct("doc_id", "text_key") == F.col("first")).alias("stays"), "many",
    )
    alone = placed.where(~F.col("many")).select(
        "doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("stays"),
        "many",
    )
    return alone.union(together).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        "text_key", "stays", "many",
    )


def op8_minhash(spark, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.drop("text_key", "stays", "many")
