"""Token ids of whole texts by a public tokenizer, each distinct part of a text encoded once."""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex

from sitewatch.llm.common import text_slices

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
SLICE_BYTES = 8 << 20

# How the two tokenizers split a text before they look up its parts.
_SPLIT = {
    BYTE_BPE: r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
    WORD_BPE: r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}

# Classes of bytes in texts of U+0020 to U+007E, U+00C0 to U+024F and line feeds.
_LETTER, _DIGIT, _OTHER, _SPACE, _BREAK, _UNUSUAL = range(6)
_CLASS = np.full(256, _UNUSUAL, np.uint8)
_CLASS[0x20:0x7F] = _OTHER
_CLASS[ord("A") : ord("Z") + 1] = _CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[0x80:0xC0] = _CLASS[0xC3:0xCA] = _LETTER
_CLASS[ord(" ")], _CLASS[ord("\n")] = _SPACE, _BREAK
# Two that are no letters, and one whose lower case is two characters.
_NO_LETTERS = [(0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0)]


def vocabulary(name: str, folder: str | None = None) -> str:
    """The path of a vocabulary file: in ``folder``, or where the public package keeps it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes as: visible ones are themselves."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Codes(dict):
    """Numbers keys as they are first looked up; ``new`` has those to be filled in."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        code = self[key] = len(self)
        self.new.append(key)
        return code


class Encoder:
    """The same ids as the library gives whole texts, several times faster.

    The tokenizers cut a text into parts and encode each by itself, so a part is encoded once
    and remembered. Texts of Latin letters, digits and signs are cut by their byte classes; those
    with white space side by side by the tokenizer's own expression; any other text, or one that
    may hold a special token, goes to the library as a whole. Past ``most`` parts the memory
    starts anew. With ``plain`` the strings of special tokens are ordinary text.
    """

    def __init__(
        self, name: str, folder: str | None = None, most: int = 700_000, plain: bool = False
    ):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(vocabulary(name, folder))
        self._tokenizer.encode_special_tokens = plain
        self.size = self._tokenizer.get_vocab_size()
        self._model = self._tokenizer.model
        self._letters = _byte_letters()
        self._split = regex.compile(_SPLIT[name])
        self._by_word = name == WORD_BPE
        self._most = most
        self._forget()

    def _forget(self) -> None:
        self._codes, self._flat, self._ends = _Codes(), array("I"), array("q", [0])

    def _fill(self) -> None:
        new, self._codes.new = self._codes.new, []
        for part in new:
            if not (self._by_word and part.isspace()):
                written = part.decode("latin-1").translate(self._letters)
                self._flat.extend([token.id for token in self._model.tokenize(written)])
            self._ends.append(len(self._flat))

    def _apart(self, data: np.ndarray, offsets: np.ndarray) -> tuple[set[int], set[int]]:
        """The texts that only the library can encode, and those only the expression can cut."""
        kinds = _CLASS[data]
        unusual = kinds == _UNUSUAL
        pair = np.zeros(len(data), bool)
        for a, b in [*_NO_LETTERS, (ord("<"), ord("|"))]:
            pair[:-1] |= (data[:-1] == a) & (data[1:] == b)
        blank = (kinds == _SPACE) | (kinds == _BREAK)
        beside = np.flatnonzero(blank[:-1] & blank[1:]) if not self._by_word else []
        rows = lambda at: set((np.searchsorted(offsets, at, "right") - 1).tolist())
        library = rows(np.flatnonzero(unusual | pair))
        return library, rows(beside) - library

    def _bounds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the parts of usual texts begin."""
        n, kinds = len(data), _CLASS[data]
        edge = np.zeros(n, bool)
        edge[offsets[offsets < n]] = True
        begins = np.ones(n, bool)
        before = kinds[:-1]
        begins[1:] = (kinds[1:] != before) | (kinds[1:] >= _SPACE)
        if self._by_word:
            begins |= kinds == _DIGIT
        else:  # a space belongs to what follows it
            begins[1:] &= (before != _SPACE) | (kinds[1:] >= _SPACE)
        begins |= edge
        # 's 't 'm 'd 're 've 'll are parts of their own, whatever letters come after.
        marks = np.flatnonzero((data == ord("'")) & begins)
        marks = marks[marks + 1 < n]
        marks = marks[~edge[marks + 1]]
        first = data[marks + 1]
        has_second = marks + 2 < n
        second = np.where(has_second, data[np.minimum(marks + 2, n - 1)], 0)
        second[edge[np.minimum(marks + 2, n - 1)]] = 0
        short = np.isin(first, np.frombuffer(b"stmd", np.uint8))
        long = (
            (first == ord("r")) & (second == ord("e"))
            | (first == ord("v")) & (second == ord("e"))
            | (first == ord("l")) & (second == ord("l"))
        )
        begins[marks[short | long] + 1] = False
        for kept, size in ((short, 2), (long, 3)):
            after = marks[kept] + size
            begins[after[after < n]] = True
        return np.flatnonzero(begins)

    def _usual(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The codes of all parts, and how many each text has."""
        if self._by_word:
            texts = pa.compute.utf8_lower(texts)
        codes, counts = [], []
        for _, _, data, offsets in text_slices(texts, SLICE_BYTES):
            begins = self._bounds(data, offsets)
            bounds = np.append(begins, len(data)).astype(np.int64)
            parts = pa.Array.from_buffers(
                pa.large_binary(),
                len(begins),
                [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))],
            ).dictionary_encode()
            own = np.array([self._codes[x] for x in parts.dictionary.to_pylist()], np.int64)
            codes.append(own[parts.indices.to_numpy()])
            counts.append(np.diff(np.searchsorted(begins, offsets)))
        return _joined(codes, np.int64), _joined(counts, np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as one array, and how many each text has; a NULL counts as empty."""
        if len(self._codes) > self._most:
            self._forget()
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        texts = texts.cast(pa.large_string()).fill_null("")
        apart, base = {}, 0
        for _, hi, data, offsets in text_slices(texts, SLICE_BYTES):
            library, cut = self._apart(data, offsets)
            apart |= {base + row: True for row in library} | {base + row: False for row in cut}
            base = hi
        usual = np.ones(len(texts), bool)
        usual[list(apart)] = False
        codes, n_parts = self._usual(texts.filter(pa.array(usual)) if apart else texts)
        split = {}
        for row, whole in sorted(apart.items()):
            text = texts[row].as_py()
            if whole:
                split[row] = self._tokenizer.encode(text, add_special_tokens=False).ids
            else:
                split[row] = [self._codes[x.encode()] for x in self._split.findall(text)]
        self._fill()
        ids, lengths = self._ids_of(codes)
        counts = np.zeros(len(texts), np.int64)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        counts[usual] = np.diff(upto[np.concatenate([[0], np.cumsum(n_parts)])])
        if apart:
            at, parts, last = np.concatenate([[0], np.cumsum(counts)]), [], 0
            for row, own in split.items():
                own = np.array(own, np.uint32 if apart[row] else np.int64)
                own = own if apart[row] else self._ids_of(own)[0]
                parts += [ids[last : at[row]], own]
                last, counts[row] = at[row], len(own)
            ids = np.concatenate([*parts, ids[last:]])
        return ids, counts

    def _ids_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts one after the other, and how many each part has."""
        ends = np.array(self._ends, np.int64)
        flat = np.array(self._flat, np.uint32)
        lengths = ends[codes + 1] - ends[codes]
        upto = np.cumsum(lengths)
        total = int(upto[-1]) if len(upto) else 0
        return flat[np.repeat(ends[codes] - upto + lengths, lengths) + np.arange(total)], lengths


def _joined(arrays: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)


@lru_cache(maxsize=2)
def encoder(
    name: str, folder: str | None = None, plain: bool = False, most: int = 700_000
) -> Encoder:
    """One encoder for all tasks of a Python worker, so that what it remembers lasts."""
    return Encoder(name, folder, most, plain)


def byte_entries(name: str, folder: str | None = None) -> list[bytes]:
    """The bytes that each id of a byte-level vocabulary stands for."""
    from tokenizers import Tokenizer

    entries = Tokenizer.from_file(vocabulary(name, folder)).get_vocab(with_added_tokens=True)
    bytes_of = {letter: value for value, letter in _byte_letters().items()}
    out = [b""] * (max(entries.values()) + 1)
    for entry, k in entries.items():
        out[k] = bytes(map(bytes_of.__getitem__, entry))
    return out
