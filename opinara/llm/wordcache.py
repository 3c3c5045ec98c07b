"""What workers remember of words they have met, and bounded fitting samples."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class WordCache:
    """Rows of numbers by word hash, forgotten beyond ``limit`` words; ``key`` tells models apart."""

    _all: dict[str, WordCache] = {}

    def __init__(self, width: int, dtype=np.float32, limit: int = 1_000_000):
        self.limit = limit
        self.hashes, self.rows = np.empty(0, np.uint64), np.empty((0, width), dtype)

    @classmethod
    def of(cls, key: str, width: int, dtype=np.float32) -> WordCache:
        if key not in cls._all:
            cls._all.clear()  # an executor's worker serves one model at a time
            cls._all[key] = cls(width, dtype)
        return cls._all[key]

    def get(self, hashes: np.ndarray, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Rows of distinct, ascending ``hashes``; ``make`` gets the places of those not known yet."""
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        out = np.empty((len(hashes), self.rows.shape[1]), self.rows.dtype)
        out[known] = self.rows[at[known]]
        if len(new):
            out[new] = make(new)
            if len(self.hashes) + len(new) > self.limit:
                self.hashes, self.rows = self.hashes[:0], self.rows[:0]
            merged = np.concatenate([self.hashes, hashes[new]])
            order = np.argsort(merged, kind="stable")
            self.hashes, self.rows = merged[order], np.concatenate([self.rows, out[new]])[order]
        return out


class RaggedCache:
    """Runs of numbers of any size by hash, in arrays; beyond ``limit`` runs those used last stay."""

    def __init__(self, limit: int):
        self.limit, self.turn = limit, 0
        self.hashes, self.used = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.start, self.size, self.flat = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint32)

    def get(self, hashes: np.ndarray, make: Callable[[list[int]], list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and numbers, one after the other, of distinct, ascending ``hashes``; ``make`` gets the places of new ones."""
        self.turn += 1
        at = self._find(hashes)
        known = at >= 0
        self.used[at[known]] = self.turn
        new = np.flatnonzero(~known)
        if len(new):
            runs = make(new.tolist())
            if len(self.hashes) + len(new) > self.limit:
                self._forget()
            size = np.fromiter(map(len, runs), np.int32, len(runs))
            start = len(self.flat) + np.cumsum(size, dtype=np.int64) - size
            self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(runs), np.uint32, int(size.sum())))
            merged = np.append(self.hashes, hashes[new])
            order = np.argsort(merged, kind="stable")
            self.hashes, self.start, self.size = merged[order], np.append(self.start, start)[order], np.append(self.size, size)[order]
            self.used = np.append(self.used, np.full(len(new), self.turn, np.int32))[order]
            at = self._find(hashes)
        return self.size[at].astype(np.int64), self.flat[spread(self.start[at], self.size[at].astype(np.int64))]

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        inside = at < len(self.hashes)
        at[~inside] = -1
        at[inside] = np.where(self.hashes[at[inside]] == hashes[inside], at[inside], -1)
        return at

    def _forget(self) -> None:
        """Keep the half used last, but all that this turn needs."""
        keep = self.used == self.turn
        if len(self.used) > self.limit // 2:
            keep |= self.used > np.partition(self.used, len(self.used) - self.limit // 2)[len(self.used) - self.limit // 2]
        size = self.size[keep].astype(np.int64)
        self.flat = self.flat[spread(self.start[keep], size)]
        self.hashes, self.used, self.size = self.hashes[keep], self.used[keep], self.size[keep]
        self.start = np.cumsum(size) - size


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of runs one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def bounded_sample(ids: DataFrame, by: str, rows: int) -> DataFrame:
    """At most ``rows`` of ``ids`` for each value of ``by``, in a hashed order of ``doc_id``.

    Rows far behind in that order are left out first, by the counts of the values, so a
    value of very many rows brings about ``2 * rows`` of them together.
    """
    counts = ids.groupBy(by).agg(F.count("*").alias("rows_of_value"))
    place = F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5
    near = ids.join(counts, by).filter(place * F.col("rows_of_value") <= 2.0 * rows + 100).drop("rows_of_value")
    window = Window.partitionBy(by).orderBy(F.xxhash64("doc_id"), "doc_id")
    return near.withColumn("nth", F.row_number().over(window)).filter(F.col("nth") <= rows).drop("nth")
