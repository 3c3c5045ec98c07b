"""Words of whole texts as numpy arrays: one pass over code points, no Python loop per word.

A word is a run of code points outside a separator set of ASCII characters.  Its
64-bit hash is a polynomial over lower-cased code points, mixed at the end, so equal
words have equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLAB = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(129, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(129, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), 128]] = False
NOT_ALNUM[0x41:0x5B] = False

_powers: list[np.ndarray] = []


class Words(NamedTuple):
    """Per word: its text's place in the list, first and past-last character in that text, hash."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLAB + 1)
        up = np.full(size, BASE, np.uint64)
        up[0] = 1
        down = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit result; zero stays apart from small numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def run_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ``points[start:end]``."""
    up, down = powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def _slabs(joined: str) -> Iterator[tuple[int, str]]:
    """Pieces of about SLAB characters, cut after a line break or space."""
    at = 0
    while at < len(joined):
        stop = at + SLAB
        if stop < len(joined):
            cut = max(joined.rfind("\n", at, stop), joined.rfind(" ", at, stop))
            if cut < 0:
                ahead = [c for c in (joined.find("\n", stop), joined.find(" ", stop)) if c >= 0]
                cut = min(ahead, default=len(joined))
            stop = cut + 1
        yield at, joined[at:stop]
        at = stop


def split(texts: list[str], separators: np.ndarray = SPACE, lower: bool = True) -> Words:
    """Words of all texts; ``separators`` marks the ASCII separators, line break and space among them."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    starts, ends, hashes = [], [], []
    for at, slab in _slabs("\n".join(texts)):
        points = code_points(slab)
        if lower:
            points = points + np.uint32(32) * ((points >= 65) & (points <= 90))
        inside = np.zeros(len(points) + 2, np.int8)
        inside[1:-1] = ~separators[np.minimum(points, 128)]
        edges = np.diff(inside)
        s, e = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(run_hashes(points, s, e))
    start = np.concatenate([np.empty(0, np.int64), *starts])
    end = np.concatenate([np.empty(0, np.int64), *ends])
    text = np.searchsorted(bounds, start, "right") - 1
    return Words(text, start - bounds[text], end - bounds[text], np.concatenate([np.empty(0, np.uint64), *hashes]))


def offsets(words: Words, n_texts: int) -> np.ndarray:
    """Place of each text's first word, and the end: ``n_texts + 1`` numbers."""
    return np.searchsorted(words.text, np.arange(n_texts + 1))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (also across texts; callers mask those)."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(BASE) + hashes[i : len(out) + i]
    return mix(out)


def column_groups(column: pa.Array, size: int = 2 * SLAB) -> Iterator[tuple[int, list[str]]]:
    """The ``groups`` of an Arrow column; only the texts of one group at a time are Python strings."""
    sizes = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
    at, total = 0, 0
    for i, n in enumerate([*sizes, size]):
        if i > at and total + n > size or i == len(sizes) > at:
            yield at, [t or "" for t in column.slice(at, i - at).to_pylist()]
            at, total = i, 0
        total += n


def groups(texts: list[str | None], size: int = 2 * SLAB) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``size`` characters together, nulls as empty, with the first one's place."""
    at, total, some = 0, 0, []
    for i, text in enumerate(texts):
        text = text or ""
        if some and total + len(text) > size:
            yield at, some
            at, total, some = i, 0, []
        some.append(text)
        total += len(text)
    if some:
        yield at, some
