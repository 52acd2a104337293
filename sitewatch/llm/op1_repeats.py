"""Substring dedup: windows of 20 words that occurred before are located by Aho-Corasick automata.

1. Anchors. Of the hashes of all 6-word runs within a window, the smallest is the window's anchor,
   so equal windows have equal anchors wherever they stand. Neighbouring windows mostly share
   theirs; such a row of windows is one ``(doc, h, start, n)``, about one for 8 words. Only
   the hashes are counted first, combined before the shuffle.
2. Rows of windows whose anchor occurs again are cut out of the texts, as segments of about 26
   words, and sent to the cell their anchor belongs to. Equal windows meet in one cell. Nothing
   else of the texts is moved for the search.
3. A cell is some thousand segments. It confirms which windows recur, joins those that always
   follow each other to phrases, compiles them into an automaton, and streams its segments
   through it in the order ``(doc, start)``: every occurrence but the first is covered. Words
   are written as two or three letters of a small alphabet, one for each place, so that an
   automaton has few branches and matches whole words.
4. An anchor with more than ``HEAVY`` rows would fill a cell. Its recurring windows are confirmed
   by an aggregation over their texts instead, with their first places; its automata are split
   by patterns, and its segments are dealt out over copies of them, so any number of occurrences
   is spread over the cluster.
5. Covered spans are joined to the documents; texts without any never leave the JVM.

``doc`` is ``doc_id`` and ``text_key``, a hash of the text.

Defined cases: a NULL text has no word; white space is not part of a word, and a text with fewer
words than a window is kept; rows with one ``doc_id`` and one text count as one document, those
with one ``doc_id`` and different texts as documents of their own, in the order of a hash of the
text; a row with NULL ``doc_id`` keeps all its words and no other row is compared with it; an empty
table gives no row; other columns go through unchanged, but for those named like a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import Words, ngrams, own_columns, signed, store, text_slices

WINDOW = 20
GRAM = 6
HEAVY = 4_000
CELL = 2_000
STREAM = 8_000

_ROWS = "doc_id long, text_key long, h long, start int, n int"
_SEGMENTS = "doc_id long, text_key long, h long, often long, start int, n int, text binary"
_SPANS = "doc_id long, text_key long, lo int, hi int"
_DOC = ["doc_id", "text_key"]
_PATTERN, _SELF_CONFIRMED, _STREAMED = range(3)


def _keyed(docs: DataFrame) -> DataFrame:
    return own_columns(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))


def anchors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of windows of each document with their anchor's hash."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                words = Words(data, offsets)
                grams = ngrams(words.hashes, gram)
                inside = window - gram + 1
                n = len(grams) - inside + 1
                doc = np.repeat(np.arange(hi - lo), words.counts)
                whole = words.left() >= window
                if n <= 0 or not whole.any():
                    continue
                least = grams[:n].copy()
                for k in range(1, inside):
                    np.minimum(least, grams[k : k + n], out=least)
                place = np.zeros(n, np.int64)
                for k in range(inside - 1, -1, -1):
                    place[grams[k : k + n] == least] = k
                at = np.flatnonzero(whole[:n])
                place = place[at] + at
                new = np.ones(len(at), bool)
                new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
                heads = np.flatnonzero(new)
                first = at[heads]
                owner = doc[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(lo, hi - lo).take(pa.array(owner)) for c in _DOC),
                        pa.array(signed(least[first])),
                        pa.array((first - words.first[owner]).astype(np.int32)),
                        pa.array(np.diff(np.append(heads, len(at))).astype(np.int32)),
                    ],
                    names=[*_DOC, "h", "start", "n"],
                )

    known = _keyed(docs).where(F.col("doc_id").isNotNull())
    return known.mapInArrow(find, _ROWS)


def _segments(docs: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """The words of the rows of windows, cut out of their documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SEGMENTS.split(", ")]
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                words = Words(data, offsets)
                rows = batch.column("rows").slice(lo, hi - lo)
                doc = np.repeat(np.arange(hi - lo), pa.compute.list_value_length(rows).to_numpy())
                fields = dict(zip(("h", "often", "start", "n"), rows.flatten().flatten()))
                start, n = fields["start"].to_numpy(), fields["n"].to_numpy()
                first = words.first[doc] + start
                last = first + n + window - 2
                first, last = words.starts[first], words.ends[last]
                size = last - first
                bounds = np.concatenate([[0], np.cumsum(size)])
                at = np.repeat(first - bounds[:-1], size) + np.arange(bounds[-1])
                text = pa.Array.from_buffers(
                    pa.large_binary(),
                    len(size),
                    [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[at])],
                ).cast(pa.binary())
                ids = [batch.column(c).slice(lo, hi - lo).take(pa.array(doc)) for c in _DOC]
                others = [fields[c] for c in ("h", "often", "start", "n")]
                yield pa.RecordBatch.from_arrays([*ids, *others, text], names=names)

    # A document has at most as many rows as words.
    of_doc = rows.groupBy(*_DOC).agg(
        F.collect_set(F.struct("h", "often", "start", "n")).alias("rows")
    )
    return _keyed(docs).join(of_doc, _DOC).mapInArrow(cut, _SEGMENTS)


class Alphabet(dict):
    """Writes words as letters: one set of letters for each place, so matches start at words."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: bytes) -> str:
        k = len(self) + 1
        if k >> 8 * self.size:
            raise OverflowError
        code = self[word] = self._code(k)
        return code

    def _code(self, k: int) -> str:
        return "".join(chr(256 * (i + 1) + (k >> 8 * i & 255)) for i in range(self.size))

    def write(self, text: bytes) -> str:
        return "".join([self[w] for w in text.split()])

    def write_known(self, text: bytes) -> str:
        get, unknown = self.get, self._code(0)
        return "".join([get(w, unknown) for w in text.split()])


def _written(texts: list[bytes]) -> tuple[Alphabet, list[str]]:
    """All texts in the smallest alphabet that has enough letters."""
    for size in (2, 3):
        alphabet = Alphabet(size)
        try:
            return alphabet, [alphabet.write(t) for t in texts]
        except OverflowError:
            continue
    raise ValueError("a cell has too many words")


def _phrases(texts: list[str], windows: list[int], width: int, step: int) -> dict[str, int]:
    """Recurring windows, joined to phrases where they always follow each other; their windows.

    Two windows always stand together if the first one always goes on with the same word, and
    both occur equally often.
    """
    often: dict[str, int] = {}
    after: dict[str, str | None] = {}
    for text, n in zip(texts, windows):
        for i in range(0, n * step, step):
            window, word = text[i : i + width], text[i + width : i + width + step]
            k = often.get(window)
            if k is None:
                often[window], after[window] = 1, word
            else:
                often[window] = k + 1
                if after[window] != word:
                    after[window] = None
    phrases: dict[str, int] = {}
    used: set[str] = set()
    for text, n in zip(texts, windows):
        i = 0
        while i < n * step:
            window = text[i : i + width]
            k = often[window]
            if k < 2 or window in used:
                i += step
                continue
            used.add(window)
            at = i
            while i + step < n * step and after[window]:
                following = text[i + step : i + step + width]
                if often[following] != k or following in used:
                    break
                window = following
                used.add(window)
                i += step
            phrases[text[at : i + width]] = (i - at) // step + 1
            i += step
    return phrases


def _cell(
    patterns: list[tuple] | None, segments: list[tuple], window: int
) -> Iterator[tuple[int, int, int, int]]:
    """The covered spans ``(doc_id, text_key, lo, hi)`` of one cell.

    ``patterns`` are confirmed windows ``(text, doc, start)`` with their first places. If they
    are None, the windows that occur again among the segments are the patterns, and the first
    match of each is its first place.
    """
    if patterns is not None:
        alphabet, keys = _written([p[0] for p in patterns])
        phrases = dict.fromkeys(keys, 1)
        first = {key: (doc, start) for key, (_, doc, start) in zip(keys, patterns)}
        first = [first[key] for key in phrases]
        written = (alphabet.write_known(s[3]) for s in segments)
    else:
        alphabet, written = _written([s[3] for s in segments])
        phrases = _phrases(
            written, [s[2] for s in segments], window * alphabet.size, alphabet.size
        )
        first = [None] * len(phrases)
    if not phrases:
        return
    step = alphabet.size
    automaton = ahocorasick.Automaton()
    for k, phrase in enumerate(phrases):
        automaton.add_word(phrase, k)
    automaton.make_automaton()
    sizes = list(phrases.values())
    for (doc, start, _, _), text in zip(segments, written):
        lo = hi = -1
        for end, k in automaton.iter(text):
            stop = start + (end + 1) // step
            at = stop - sizes[k] - window + 1
            if first[k] is None:
                first[k] = (doc, at)
            if first[k] == (doc, at):
                continue
            if at <= hi:
                hi = stop
            else:
                if hi > 0:
                    yield *doc, lo, hi
                lo, hi = at, stop
        if hi > 0:
            yield *doc, lo, hi


def _search(cells: DataFrame, window: int) -> DataFrame:
    """Runs all cells; in a partition one follows the other, patterns before segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, patterns, segments = None, [], []

        def spans(rows):
            columns = list(zip(*rows)) if rows else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_DOC, "lo", "hi"]
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in _CELL_COLUMNS]
            for own, kind, doc_id, text_key, start, n, text in zip(*columns):
                # Confirmed patterns need no second pass, so their segments go through in parts.
                if own != cell or (kind == _STREAMED and len(segments) >= STREAM):
                    if segments:
                        yield spans(list(_cell(patterns, segments, window)))
                    if own != cell:
                        cell, patterns = own, None if kind == _SELF_CONFIRMED else []
                    segments = []
                if kind == _PATTERN:
                    patterns.append((text, (doc_id, text_key), start))
                else:
                    segments.append(((doc_id, text_key), start, n, text))
        if segments:
            yield spans(list(_cell(patterns, segments, window)))

    return cells.mapInArrow(run, _SPANS)


_CELL_COLUMNS = ["cell", "kind", *_DOC, "start", "n", "text"]


def covered(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    heavy: int = HEAVY,
    cell: int = CELL,
    stream: int = STREAM,
) -> DataFrame:
    """``(doc_id, text_key, lo, hi)``: words that some window covers which also starts earlier."""
    rows = anchors(docs, window, gram)
    # Stored, as a join can only split a heavy anchor if both its sides come from a shuffle.
    again = rows.groupBy("h").agg(F.count("*").alias("often")).where("often > 1")
    again = store(again, "op1-again")
    rows = store(rows.join(again, "h"), "op1-rows")
    total, n_heavy = rows.agg(F.count("*"), F.count_if(F.col("often") > heavy)).first()
    segments = store(_segments(docs, rows, window), "op1-segments")
    n_cells = total // cell + 1

    light = segments.where(F.col("often") <= heavy).select(
        F.pmod(F.xxhash64("h"), F.lit(n_cells)).alias("cell"),
        F.lit(_SELF_CONFIRMED).alias("kind"), *_DOC, "start", "n", "text",
    )
    cells = light
    if n_heavy:
        cells = light.union(
            _heavy_cells(segments.where(F.col("often") > heavy), window, cell, stream)
        )
    ordered = cells.repartition("cell").sortWithinPartitions("cell", "kind", *_DOC, "start")
    return store(_search(ordered, window), "op1-spans")


def _heavy_cells(segments: DataFrame, window: int, cell: int, stream: int) -> DataFrame:
    """Cells of the heavy anchors: confirmed patterns by part, segments dealt over copies."""
    # Equal segments are one first: most rows of a heavy anchor are copies of a passage.
    distinct = segments.groupBy("h", "n", "text").agg(
        F.min(F.struct(*_DOC, "start")).alias("first"), F.count("*").alias("k")
    )
    words = F.split(F.decode("text", "UTF-8"), r"[\x20\x09-\x0D]+", -1)
    windows = distinct.select(
        "h", "first", "k", words.alias("words"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i")
    ).select(
        "h",
        "k",
        F.array_join(F.slice("words", F.col("i") + 1, window), " ").alias("text"),
        F.struct("first.doc_id", "first.text_key", (F.col("first.start") + F.col("i")).alias("start"))
        .alias("place"),
    )
    confirmed = (
        windows.groupBy("h", "text")
        .agg(F.min("place").alias("place"), F.sum("k").alias("k"))
        .where("k > 1")
        .drop("k")
    )
    confirmed = store(confirmed, "op1-heavy")
    # One row for each heavy anchor: into how many parts and copies it is split.
    split = confirmed.groupBy("h").agg(F.ceil(F.count("*") / cell).cast("int").alias("parts"))
    often = segments.groupBy("h").agg(F.ceil(F.count("*") / stream).cast("int").alias("copies"))
    split = store(split.join(often, "h"), "op1-split")
    # Below zero, where no other cell is.
    cell_id = (-1 - F.shiftrightunsigned(F.xxhash64("h", "part", "copy"), 1)).alias("cell")
    patterns = confirmed.join(split, "h").select(
        "h",
        F.pmod(F.xxhash64("text"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
        "place", "text",
    ).select(
        cell_id, F.lit(_PATTERN).alias("kind"), "place.doc_id", "place.text_key", "place.start",
        F.lit(1).alias("n"), F.encode("text", "UTF-8").alias("text"),
    )
    streams = segments.join(split, "h").select(
        "h", F.pmod(F.xxhash64("doc_id"), "copies").cast("int").alias("copy"),
        "parts", *_DOC, "start", "n", "text",
    )
    # Nearly every anchor has one part; only the others' segments are repeated.
    more = streams.where("parts > 1").withColumn(
        "part", F.explode(F.sequence(F.lit(1), F.col("parts") - 1))
    )
    streams = streams.withColumn("part", F.lit(0)).unionByName(more).select(
        cell_id, F.lit(_STREAMED).alias("kind"), *_DOC, "start", "n", "text"
    )
    return patterns.union(streams)


def remove_repeats(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``, the kept words joined by a space."""

    def keep(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in columns:
            n_words, n_removed, kept = [], [], []
            for text, own in zip(texts.cast(pa.large_binary()), spans.to_pylist()):
                words = (text.as_py() or b"").split()
                n_words.append(len(words))
                if own:
                    gone = np.zeros(len(words) + 1, bool)
                    for span in own:
                        gone[span["lo"] : span["hi"]] = True
                    words = [w for w, x in zip(words, gone) if not x]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["n_words", "n_removed", "kept_text"],
            )

    spans = covered(docs, **parameters)
    spans = spans.groupBy(*_DOC).agg(F.collect_set(F.struct("lo", "hi")).alias("__spans"))
    spans = spans.toDF("__id", "__text_key", "__spans")
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    joined = own_columns(docs, *names).withColumn("__key", F.xxhash64("text"))
    same = (F.col("doc_id") == F.col("__id")) & (F.col("__key") == F.col("__text_key"))
    joined = joined.join(spans, same, "left")
    has_spans = F.col("__spans").isNotNull()
    result = F.arrow_udf(keep, "n_words long, n_removed long, kept_text string")
    cut = result(F.when(has_spans, F.col("text")), "__spans")
    blank = F.lit(r"[\x20\x09-\x0D]+")
    whole = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), blank, F.lit(" ")))
    joined = joined.withColumn("__cut", cut).withColumn("__whole", F.when(~has_spans, whole))
    return joined.select(
        *[F.col(f"`{c}`") for c in names],
        F.when(has_spans, F.col("__cut.n_words")).otherwise(
            F.when(F.col("__whole") == "", 0).otherwise(
                F.length(F.regexp_replace("__whole", "[^ ]+", "")) + 1
            )
        ).cast("long").alias("n_words"),
        F.when(has_spans, F.col("__cut.n_removed")).otherwise(0).cast("long").alias("n_removed"),
        F.when(has_spans, F.col("__cut.kept_text")).otherwise(F.col("__whole")).alias("kept_text"),
    )


def op1_repeats(spark, sf_dir: str) -> DataFrame:
    """What is left of every document once repeated windows of 20 words are removed."""
    docs = own_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
