"""Piece ids of whole texts by a public SentencePiece model, each distinct chunk encoded once."""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

from sitewatch.llm.tokens import _Codes, vocabulary

PIECE_BPE = "piece_bpe_32k.model"
_SPACE = "▁"


class PieceEncoder:
    """The ids the library gives a text, from ``space + text``.

    A chunk is a run of spaces and what follows up to the next space. No piece of the model goes
    on past one, which is checked, so chunks are encoded by themselves and remembered; past
    ``most`` chunks the memory starts anew.
    """

    def __init__(self, name: str = PIECE_BPE, folder: str | None = None, most: int = 200_000):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=vocabulary(name, folder))
        pieces = [self._model.id_to_piece(k) for k in range(self._model.get_piece_size())]
        if any(_SPACE in piece.lstrip(_SPACE) for piece in pieces):
            raise ValueError("a piece of this model goes on past a space")
        self.entries = [
            bytes([int(piece[3:-1], 16)])
            if self._model.is_byte(k)
            else piece.replace(_SPACE, " ").encode()
            for k, piece in enumerate(pieces)
        ]
        self._space = self._model.piece_to_id(_SPACE)
        self._most = most
        self._forget()

    def _forget(self) -> None:
        self._codes, self._flat, self._ends = _Codes(), array("I"), array("q", [0])
        self._same = array("b")

    def _fill(self) -> None:
        new, self._codes.new = self._codes.new, []
        # The model puts a space before each text; it is the chunk's first one.
        for chunk, ids in zip(new, self._model.encode([c[1:].decode() for c in new], num_threads=1)):
            ids = ids or [self._space]
            self._flat.extend(ids)
            self._ends.append(len(self._flat))
            self._same.append(b"".join(map(self.entries.__getitem__, ids)) == chunk)

    def __call__(
        self, data: np.ndarray, offsets: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, how many each text has, and whether its joined pieces are its bytes.

        Each text in ``data`` begins with the space that the model adds.
        """
        if len(self._codes) > self._most:
            self._forget()
        n = len(data)
        space = data == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[offsets[offsets < n]] = True
        begins = np.flatnonzero(begins)
        bounds = np.append(begins, n).astype(np.int64)
        chunks = pa.Array.from_buffers(
            pa.large_binary(),
            len(begins),
            [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))],
        ).dictionary_encode()
        codes = np.array([self._codes[x] for x in chunks.dictionary.to_pylist()], np.int64)
        self._fill()
        codes = codes[chunks.indices.to_numpy()]
        ends, flat = np.frombuffer(self._ends, np.int64), np.frombuffer(self._flat, np.uint32)
        lengths = ends[codes + 1] - ends[codes]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[np.repeat(ends[codes] - upto[:-1], lengths) + np.arange(upto[-1])].astype(np.int64)
        first = np.searchsorted(begins, offsets)
        wrong = np.concatenate([[0], np.cumsum(np.frombuffer(self._same, np.int8)[codes] == 0)])
        return ids, np.diff(upto[first]), np.diff(wrong[first]) == 0


@lru_cache(maxsize=2)
def piece_encoder(name: str = PIECE_BPE, folder: str | None = None) -> PieceEncoder:
    """One encoder for all tasks of a Python worker, so that what it remembers lasts."""
    return PieceEncoder(name, folder)
