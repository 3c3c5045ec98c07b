"""Best-fit-decreasing packing of token pieces into sequences of a fixed size.

Best fit looks only at lengths, so the packing is planned on the counts of lengths (at
most ``capacity`` numbers) and every piece finds its place from its rank within its
length.  Bins filled alike are kept as one range of bins, and a segment tree over
remaining capacities gives the tightest open range in logarithmic time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from .simple8b import _in_parts
from .tokens import PieceTokenizer


class CapacityTree:
    """Which remaining capacities have an open bin; ``tightest(n)`` is the smallest of at least ``n``."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, remaining: int, is_open: bool) -> None:
        at = self.leaves + remaining
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        at = self.leaves + need
        if self.open[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, first bin, pieces per bin, offset)``, ranks from 0 within a length.

    The pieces of a run fill bins one after the other, ``pieces per bin`` in each from
    ``offset`` on.
    """
    tree, ranges = CapacityTree(capacity), {}  # remaining -> [(first bin, past-last bin)]
    runs, bins = [], 0

    def add(remaining: int, first: int, last: int) -> None:
        if first < last and remaining:
            ranges.setdefault(remaining, []).append((first, last))
            tree.set(remaining, True)

    for length in sorted((n for n in counts if n), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                each = room // length
                first, last = bins, bins + -(-left // each)
                bins = last
            else:
                first, last = ranges[room].pop()
                if not ranges[room]:
                    tree.set(room, False)
                each = room // length
            full = min(last - first, left // each)
            runs.append((length, rank, first, each, capacity - room))
            rank, left = rank + full * each, left - full * each
            add(room - each * length, first, first + full)
            if left and full < last - first:  # the last bin takes what is left
                add(room - left * length, first + full, first + full + 1)
                add(room, first + full + 1, last)
                left = 0
            else:
                add(room, first + full, last)
    return runs


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Token pieces: ``doc_id, piece, start, length, ids_crc32``, and ``part, nth`` to rank them within a length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = PieceTokenizer.load(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), _in_parts(coder, texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), capacity)):
                    some = ids[start : start + capacity]
                    rows.append((doc, number, start, len(some), zlib.crc32(some.tobytes()), part, seen[len(some)]))
                    seen[len(some)] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, ddl)


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """Place written ``pieces``: adds ``sequence_id`` and ``offset``.

    Ranks within a length come from counts per (task, length), so no length, however
    common, meets in one task.
    """
    per_task = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    runs = np.array(plan(counts, capacity) or [(0, 0, 0, 1, 0)], np.int64)
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    length, first_rank, first_bin, each, offset = runs[order].T

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = np.searchsorted(length, np.arange(capacity + 2))
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = np.zeros(len(size), np.int64)
            for n in np.unique(size).tolist():
                mine = size == n
                low, high = begins[n], begins[n + 1]
                run[mine] = low + np.searchsorted(first_rank[low:high], rank[mine], "right") - 1
            nth = rank - first_rank[run]
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(first_bin[run] + nth // each[run]), pa.array(offset[run] + nth % each[run] * size)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, ddl)


def best_fit(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Every document (null text: empty) packed; documents over ``capacity`` are cut into pieces of that size."""
    return pack(write_once(pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
