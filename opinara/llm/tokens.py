"""Token ids of whole texts with a public tokenizer file.

The tokenizer splits a text into pieces and codes each piece alone, so pieces are
found for many texts at once, each distinct piece is coded once by the tokenizer's own
model, and ids are gathered.  Texts beyond the letters for which this is known to be
exact go through the tokenizer whole.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

from . import words as W
from .wordcache import RaggedCache

SAFE = 0x250  # below: each letter lower-cases to one letter and is its own composed form
CACHED_PIECES = 500_000
_LETTER, _DIGIT, _SPACE, _OTHER = range(4)


def _class(c: int) -> int:
    ch = chr(c)
    if ch.isspace():
        return _SPACE
    kind = unicodedata.category(ch)[0]
    return {"L": _LETTER, "N": _DIGIT}.get(kind, _OTHER)


_CLASSES = np.array([_class(c) for c in range(SAFE)], np.int8)
_LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else 0 for c in range(SAFE)], np.uint32)
_UNSAFE = re.compile("[^" + re.escape("".join(
    chr(c) for c in range(SAFE) if c == 0 or 0 < _LOWER[c] < SAFE and not 0x1C <= c <= 0x1F)) + "]")
_CONTRACTION = re.compile("'(?:[stmd]|re|ve|ll)", re.IGNORECASE)


class PieceTokenizer:
    """Ids of texts; keeps at most ``CACHED_PIECES`` coded pieces between calls."""

    _loaded: dict[str, PieceTokenizer] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = RaggedCache(CACHED_PIECES)

    @classmethod
    def load(cls, path: str) -> PieceTokenizer:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    @classmethod
    def forget(cls) -> None:
        """A worker that goes on with other work need not keep tokenizers and their pieces."""
        cls._loaded.clear()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        slow = [bool(_UNSAFE.search(t) or "'" in t and _CONTRACTION.search(t)) or any(s in t for s in self.special) for t in texts]
        out: list[np.ndarray] = [self.whole(t) if s else None for t, s in zip(texts, slow)]
        fast = [i for i, s in enumerate(slow) if not s]
        for at, some in W.groups([texts[i] for i in fast], W.SLAB):
            for i, ids in enumerate(self._fast(some)):
                out[fast[at + i]] = ids
        return out

    def _fast(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\n".join(texts)
        points = _LOWER[W.code_points(joined)] if joined else np.empty(0, np.uint32)
        kind = _CLASSES[points]
        opens = np.ones(len(points), bool)
        opens[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        edges = np.append(np.flatnonzero(opens), len(points))
        solid = kind[edges[:-1]] != _SPACE
        start, end = edges[:-1][solid], edges[1:][solid]
        hashes, first, which = np.unique(W.run_hashes(points, start, end), return_index=True, return_inverse=True)
        if not len(hashes):
            return [np.empty(0, np.uint32) for _ in texts]
        lowered: list[str] = []

        def code(new: list[int]) -> list[list[int]]:
            lowered.append(points.tobytes().decode("utf-32-le"))
            return [self._piece(lowered[0][start[i] : end[i]]) for i in first[new].tolist()]

        sizes, flat = self.known.get(hashes, code)
        begins = np.cumsum(sizes) - sizes
        n = sizes[which]
        ends = np.cumsum(n)
        ids = flat[np.repeat(begins[which] - (ends - n), n) + np.arange(ends[-1])]
        limits = np.cumsum([len(t) + 1 for t in texts])
        cuts = np.append(0, ends)[np.searchsorted(start, limits)]
        return np.split(ids, cuts[:-1])

    def _piece(self, piece: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize("".join(_BYTES[b] for b in piece.encode()))]


def _byte_letters() -> list[str]:
    """The printable letter for each byte in byte-level vocabularies: printable bytes as themselves, the rest from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


_BYTES = _byte_letters()


def path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
