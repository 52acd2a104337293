"""Benchmark decontamination by canonical templates.

Texts become templates: letters and numbers only, lower case, numbers, names (capitalised words
inside a sentence) and units (after a number) replaced by a placeholder of their type. A question
asked again with other numbers or names has the same template. As capitals tell names, every text
has a second template that keeps names as words, which copies in other capitals share, and a third
that has a slot for capitalised words at the start of a sentence, too, and one slot for a name of
several words.

1. Of each template window of ``WINDOW`` tokens the smallest hash among its runs of ``GRAM`` tokens
   is its anchor, so equal windows share theirs. Runs with fewer than two words are no anchors.
   An item shorter than a window has its whole template as anchor, which documents are searched for
   at every place; a table of bits of fixed size leaves out most places before the join.
   The anchors of documents and items are hash-joined.
2. Items of one template whose slots repeat in the same places are one class: whether a document
   agrees with them does not depend on their values. A document meets a class once, however many
   items it has. Each such pair is aligned in full: the longest run of tokens whose template
   windows are equal and whose slots are consistent, that is, each value of the item stands for one
   value of the document and the other way round. Which item of the class a document has word for
   word is found by a join of hashes.
3. A document leaks an item if that run has ``ENOUGH`` tokens, or all of a shorter item's; or if it
   has, with the runs of ``GRAM`` tokens beside it that agree in order and slots, ``SHARE`` of the
   item. An item shorter than a window leaks as a whole: verbatim, or with ``FEW_WORDS`` words
   outside its slots.

Defined cases: NULL or empty texts and items match nothing, nor does an item of fewer than
``SHORTEST`` tokens or two words, which is too short to tell; an item with several texts is
searched by each; documents and items with NULL ids are left out; rows of one ``doc_id`` are told
apart by ``text_key``, a hash of their text; repeated rows give one row for each pair; empty tables
give no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import Tokens, mix, ngrams, own_columns, signed, store, text_slices

WINDOW = 10
GRAM = 5
ENOUGH = 13
SHARE = 0.75
SHORTEST = 3
LEAST_WORDS = 2
FEW_WORDS = 5
FORMS = 3
BITS = 1 << 23

_NUMBER, _NAME, _UNIT = (np.uint64(k) for k in (1, 2, 3))
UNITS = (
    "percent km kilometers kilometres miles meters metres m cm mm feet foot inches inch yards "
    "kg g mg grams kilograms pounds ounces tons liters litres ml gallons seconds second minutes "
    "minute hours hour days day weeks week months month years year dollars dollar euros euro "
    "cents cent degrees mph kmh watts volts bytes kb mb gb"
).split()

_CLASSES = "key long, c1 long, c2 long, words long"
_FOUND = (
    "doc_id long, text_key long, template long, n_tokens int, doc_start int, item_start int, "
    "n_slots int, words long, exact boolean"
)
_RUN = ["n_tokens", "doc_start", "item_start", "n_slots"]
_known_units: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _known_units:
        data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
        _known_units.append(np.sort(Tokens(data, np.array([0, len(data)])).hashes))
    return _known_units[0]


class Templates:
    """The tokens of some texts and their templates, in each of ``FORMS`` forms."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        tokens = Tokens(data, offsets)
        n = len(tokens.hashes)
        after_number = np.zeros(n, bool)
        after_number[1:] = tokens.is_number[:-1]
        heads = tokens.first[:-1][tokens.first[:-1] < n]
        after_number[heads] = False
        unit = after_number & np.isin(tokens.hashes, _unit_hashes())
        other = np.select([tokens.is_number, unit], [_NUMBER, _UNIT], np.uint64(0))
        capital = tokens.is_capitalised & ~unit
        named = np.where(capital & ~tokens.is_initial, _NAME, other)
        widely = np.where(capital, _NAME, other)
        # Form 2: one slot for a run of names within a sentence, valued by all of its words.
        goes_on = np.zeros(n, bool)
        goes_on[1:] = capital[1:] & capital[:-1] & ~tokens.is_initial[1:]
        at = np.flatnonzero(~goes_on)
        nth = (np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))).astype(np.uint64)
        values = tokens.hashes
        joined = np.add.reduceat(mix(values + mix(nth)), at) if n else values
        first = np.searchsorted(at, tokens.first)
        every = np.arange(n)
        self.kinds = (named, other, widely[at])
        self.values = (values, values, joined)
        self.first = (tokens.first, tokens.first, first)
        self.at = tuple(np.append(x, n) for x in (every, every, at))
        words = (values, values, values[at])
        self.templates = tuple(np.where(k > 0, k, w) for k, w in zip(self.kinds, words))

    def form(self, which: int, text: int) -> tuple[np.ndarray, ...]:
        """Template, values, kinds and places of one text; form 1 has names as words."""
        lo, hi = self.first[which][text], self.first[which][text + 1]
        places = self.at[which][lo : hi + 1] - self.at[which][lo]
        own = slice(lo, hi)
        return self.templates[which][own], self.values[which][own], self.kinds[which][own], places


def _least_grams(template, kinds, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window, and whether it has one."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    n = max(len(template) - window + 1, 0)
    grams = ngrams(template, gram)
    words = np.concatenate([[0], np.cumsum(kinds == 0)])
    grams[words[gram:] - words[:-gram] < LEAST_WORDS] = none
    least = grams[:n].copy()
    for k in range(1, window - gram + 1):
        np.minimum(least, grams[k : k + n], out=least)
    return least, least != none


def _anchors(
    rows: DataFrame,
    window: int,
    gram: int,
    whole: bool,
    bits: dict[int, int] | None = None,
    id_type: str = "long",
) -> DataFrame:
    """The distinct anchors of each text of ``rows (id, text)``.

    A text shorter than a window has its whole template as anchor if ``whole``; other texts have
    the runs of ``SHORTEST`` to ``window - 1`` tokens that are in ``bits`` by their hash.
    """
    known = np.zeros(BITS // 64, np.uint64)
    for word, value in (bits or {}).items():
        known[word] = np.uint64(value & 0xFFFFFFFFFFFFFFFF)
    lengths = range(SHORTEST, window) if whole or bits else ()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                texts = Templates(data, offsets)
                owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                seen = np.zeros(0, np.uint64)
                for template, kinds, first in zip(texts.templates, texts.kinds, texts.first):
                    counts = np.diff(first)
                    doc = np.repeat(np.arange(hi - lo), counts)
                    left = np.repeat(first[1:], counts) - np.arange(len(doc))
                    found = []
                    if len(template) >= window:
                        least, usable = _least_grams(template, kinds, window, gram)
                        at = np.flatnonzero(usable & (left[: len(least)] >= window))
                        new = np.ones(len(at), bool)
                        new[1:] = (least[at[1:]] != least[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
                        found.append((doc[at[new]], least[at[new]]))
                    words = np.concatenate([[0], np.cumsum(kinds == 0)])
                    for n in lengths:
                        if len(template) < n:
                            break
                        h = mix(ngrams(template, n) + np.uint64(n))
                        fits = left[: len(h)] >= n
                        fits &= words[n:] - words[:-n] >= LEAST_WORDS
                        if whole:
                            fits &= counts[doc[: len(h)]] == n
                        else:
                            bit = h % np.uint64(BITS)
                            fits &= (known[bit // 64] >> (bit % np.uint64(64))) & np.uint64(1) > 0
                        at = np.flatnonzero(fits)
                        found.append((doc[at], h[at]))
                    for own, h in found:  # without what another form has found
                        key = mix(h + mix(own.astype(np.uint64)))
                        new = ~np.isin(key, seen)
                        owners.append(own[new])
                        hashes.append(h[new])
                    seen = mix(np.concatenate(hashes) + mix(np.concatenate(owners).astype(np.uint64)))
                ids = batch.column("id").slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.concatenate(owners))),
                        pa.array(signed(np.concatenate(hashes))),
                    ],
                    names=["id", "h"],
                )

    usable = rows.where("id IS NOT NULL AND text IS NOT NULL")
    return usable.mapInArrow(find, f"id {id_type}, h long")


def _bits(short: DataFrame) -> dict[int, int]:
    """A table of ``BITS`` bits of the hashes in ``short``: its size is fixed, whatever there is."""
    # The unsigned hash modulo BITS, a power of two.
    bit = F.col("h").bitwiseAND(F.lit(BITS - 1))
    word = (F.shiftright(bit, 6)).alias("word")
    value = F.expr(f"shiftleft(1L, cast((h & {BITS - 1}) & 63 AS int))").alias("value")
    rows = short.select(word, value).groupBy("word").agg(F.bit_or("value").alias("value")).collect()
    return {r.word: r.value for r in rows}


def _templates_of(texts: list[str | None]) -> Templates:
    ((_, _, data, offsets),) = text_slices(pa.array(texts, pa.string()), 1 << 62)
    return Templates(data, offsets)


def align(doc, item, window: int) -> list[tuple[int, int, int, int, bool]]:
    """The consistent runs: tokens, where they start in both, their slots, whether verbatim.

    ``doc`` and ``item`` are (template, values, kinds, places) of one text each.
    """
    (doc_t, doc_v, doc_k, _), (item_t, item_v, item_k, _) = doc, item
    if min(len(doc_t), len(item_t)) < window:
        return []
    doc_w, item_w = ngrams(doc_t, window), ngrams(item_t, window)
    here = np.flatnonzero(np.isin(doc_w, item_w))
    places = defaultdict(list)
    for j, h in enumerate(item_w.tolist()):
        places[h].append(j)
    runs: dict[int, tuple[int, int]] = {}  # diagonal -> first and last window in the document
    found = []

    def close(shift: int, lo: int, hi: int) -> None:
        end = hi + window
        # Slots must agree; where they stop to, a new run begins.
        start, there, back = lo, {}, {}
        for i in range(lo, end + 1):
            fits = i < end
            if fits and item_k[i - shift]:
                kind, a, b = int(item_k[i - shift]), int(item_v[i - shift]), int(doc_v[i])
                fits = there.get((kind, a), b) == b and back.get((kind, b), a) == a
            if not fits:
                size = i - start
                if size >= window:
                    same = bool((doc_v[start:i] == item_v[start - shift : i - shift]).all())
                    slots = int((item_k[start - shift : i - shift] > 0).sum())
                    found.append((size, start, start - shift, slots, same))
                start, there, back = i, {}, {}
            if i < end and item_k[i - shift]:
                there[kind, a], back[kind, b] = b, a

    for i in here.tolist():
        for j in places[int(doc_w[i])]:
            run = runs.get(i - j)
            if run and run[1] == i - 1:
                runs[i - j] = (run[0], i)
            else:
                if run:
                    close(i - j, *run)
                runs[i - j] = (i, i)
    for shift, run in runs.items():
        close(shift, *run)
    return found


def _together(doc, item, best, gram: int) -> tuple[int, int, int, int, bool]:
    """``best`` with the runs of ``gram`` tokens that go with it: same order, near, same slots."""
    (_, doc_v, _, _), (_, item_v, item_k, _) = doc, item
    there, back, chain = {}, {}, []
    for run in [best, *sorted(align(doc, item, gram), reverse=True)]:
        size, i, j = run[:3]
        apart = all(
            (i + size <= x[1] and j + size <= x[2]) or (i >= x[1] + x[0] and j >= x[2] + x[0])
            for x in chain
        )
        span = max([i + size, *(x[1] + x[0] for x in chain)]) - min([i, *(x[1] for x in chain)])
        slots = [
            (int(item_k[j + k]), int(item_v[j + k]), int(doc_v[i + k]))
            for k in range(size)
            if item_k[j + k]
        ]
        fits = all(there.get((t, a), b) == b and back.get((t, b), a) == a for t, a, b in slots)
        if apart and fits and span <= 2 * len(item_v):
            chain.append(run)
            there |= {(t, a): b for t, a, b in slots}
            back |= {(t, b): a for t, a, b in slots}
    chain.sort(key=lambda x: x[1])
    total = sum(x[0] for x in chain)
    return total, chain[0][1], chain[0][2], sum(x[3] for x in chain), False


def _leak(doc, item, window: int, gram: int, enough: int):
    """The best run of one form if it is a leak: item tokens, starts, slots, whether only verbatim."""
    n = len(item[0])
    runs = align(doc, item, min(window, n)) if n >= SHORTEST else []
    if not runs:
        return None
    best = max(runs, key=lambda run: (run[0], run[4]))
    size, words = best[0], int((item[2] == 0).sum())
    if n < window and words < LEAST_WORDS:
        return None
    exact = n < window and words < FEW_WORDS
    if size < min(enough, n):
        best = _together(doc, item, best, gram)
        if best[0] < SHARE * n:
            return None
        tokens = best[0]
    else:
        tokens = int(item[3][best[2] + size] - item[3][best[2]])
    return tokens, int(doc[3][best[1]]), int(item[3][best[2]]), best[3], exact


def _words_hash(values: np.ndarray) -> int:
    """A hash of some tokens as they are written."""
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The class of each text: its templates, and which of their slots have equal values."""
    names = [c.split()[0] for c in _CLASSES.split(", ")]
    for batch in batches:
        for lo, hi, data, offsets in text_slices(batch.column("text")):
            texts, rows = Templates(data, offsets), []
            for k in range(hi - lo):
                digest = hashlib.blake2b(digest_size=16)
                for f in range(FORMS):
                    template, values, kinds, places = texts.form(f, k)
                    slots = mix(values[kinds > 0] + mix(kinds[kinds > 0]))
                    _, first, which = np.unique(slots, return_index=True, return_inverse=True)
                    for part in (template, kinds, places, first[which]):
                        digest.update(part.tobytes() + b"|")
                own = digest.digest()
                words = _words_hash(texts.form(1, k)[1])
                rows.append((*np.frombuffer(own, np.int64).tolist(), words))
            columns = zip(*rows) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").slice(lo, hi - lo), *(pa.array(list(c), pa.int64()) for c in columns)],
                names=names,
            )


def _found(
    docs: DataFrame, items: DataFrame, window: int, gram: int, enough: int
) -> tuple[DataFrame, DataFrame]:
    """The runs of documents and classes, and ``item_id, template, words`` of all items."""
    docs = own_columns(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    items = own_columns(items, "item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    # An item may have several texts and a text several items: texts are searched, once each.
    items = store(items.distinct().withColumn("key", F.xxhash64("text")), "op2-texts")
    texts = items.select("key", "text").distinct()
    described = store(texts.mapInArrow(_describe, _CLASSES), "op2-described")
    templates = described.groupBy("c1", "c2").agg(F.min("key").alias("template"))
    classed = store(described.join(templates, ["c1", "c2"]).select("key", "template", "words"), "op2-classes")
    members = store(items.select("item_id", "key").join(classed, "key").drop("key"), "op2-members")
    # One text stands for its class.
    shown = texts.join(classed.where("key = template").select("key"), "key")
    by_key = store(shown.select(F.col("key").alias("id"), "text"), "op2-shown")
    marks = _anchors(by_key, window, gram, whole=True).distinct()
    marks = store(marks.select(F.col("id").alias("template"), "h"), "op2-items")
    short = _anchors(by_key, window, gram, whole=True).join(
        _anchors(by_key, window, gram, whole=False), ["id", "h"], "left_anti"
    )
    bits = _bits(short)
    # Rows that share an id are told apart by the text they come with.
    keyed = docs.where("doc_id IS NOT NULL").select(F.struct("doc_id", "text_key").alias("id"), "text")
    found = _anchors(keyed, window, gram, False, bits, "struct<doc_id:bigint,text_key:bigint>")
    pairs = found.join(marks, "h").select("id.doc_id", "id.text_key", "template").distinct()
    pairs = store(pairs, "op2-pairs")
    wanted = pairs.join(by_key.toDF("template", "item"), "template")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 3 + [pa.int32()] * 4 + [pa.int64(), pa.bool_()]
        names = [c.split()[0] for c in _FOUND.split(", ")]
        text = own = None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["text"] != text:  # its candidates mostly follow each other
                    text, own = row["text"], _templates_of([row["text"]])
                item = _templates_of([row["item"]])
                runs = [
                    _leak(own.form(f, 0), item.form(f, 0), window, gram, enough) for f in range(FORMS)
                ]
                best = max(filter(None, runs), default=None, key=lambda run: (run[0], not run[4]))
                if best:
                    n, begin, start, slots, exact = best
                    written, whole = own.form(1, 0)[1], len(item.form(1, 0)[1])
                    # Word for word only if all of the item is there.
                    words = _words_hash(written[begin : begin + n]) if n == whole and start == 0 else None
                    ids = row["doc_id"], row["text_key"], row["template"]
                    rows.append((*ids, n, begin, start, slots, words, exact))
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    joined = docs.where("text IS NOT NULL").join(wanted, ["doc_id", "text_key"])
    return store(joined.mapInArrow(compare, _FOUND).distinct(), "op2-found"), members


def template_leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, enough: int = ENOUGH
) -> DataFrame:
    """One row for each document and class of items that it leaks, with the run they share.

    ``item_id`` is the smallest of the class, ``n_items`` how many it has; ``verbatim`` says
    whether the document has one of them word for word.
    """
    found, members = _found(docs, items, window, gram, enough)
    classes = members.groupBy("template").agg(
        F.min("item_id").alias("item_id"), F.count_distinct("item_id").alias("n_items")
    )
    exact = members.groupBy("template", "words").agg(F.min("item_id").alias("of"))
    marked = found.join(exact, ["template", "words"], "left").join(classes, "template")
    marked = marked.withColumn("verbatim", F.col("of").isNotNull()).where("verbatim OR NOT exact")
    item = F.when(F.col("exact"), F.col("of")).otherwise(F.col("item_id")).alias("item_id")
    return marked.select("doc_id", "text_key", item, "n_items", *_RUN, "verbatim")


def leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, enough: int = ENOUGH
) -> DataFrame:
    """``doc_id, item_id`` of every leak, with the longest run of tokens they share.

    This writes out all items of each class; ``template_leaks`` does not.
    """
    found, members = _found(docs, items, window, gram, enough)
    each = found.withColumnRenamed("words", "seen").join(members, "template")
    each = each.withColumn("verbatim", F.coalesce(F.col("seen") == F.col("words"), F.lit(False)))
    each = each.where("verbatim OR NOT exact")
    run = F.struct(*_RUN, "verbatim")
    longest = F.max_by(run, F.struct("n_tokens", "verbatim", "doc_start"))
    return each.groupBy("doc_id", "item_id").agg(longest.alias("run")).select(
        "doc_id", "item_id", "run.*"
    )


def op2_templates(spark, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` that leaks items of ``benchmark``, with their class."""
    found = template_leaks(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )
    return found.drop("text_key")
