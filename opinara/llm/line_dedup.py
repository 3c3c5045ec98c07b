"""Removal of passages that an earlier document already has.

A passage is any run of ``min_words`` or more words, wherever it begins or ends in a line.  Every
run of exactly ``min_words`` words is looked up by hash, and deleted from a document when a
document of smaller doc_id has it too.  A longer passage is the union of such runs, so none is
lost, whichever documents share its parts and however often any of them repeats it.

Two steps keep this small.  Each run is marked by the smallest hash among the half-runs in it;
neighbouring runs mostly share their mark, and equal runs have equal marks, so only runs whose mark
stands in two different texts are looked up.  Counts are combined before every shuffle, a run of
very many documents meets one row, and documents are never paired.  Runs are compared by 64-bit
hashes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from . import words as W
from .winnowing import _bit_set, _places


def line_places(points: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-last character of every line of a text that is not empty, and the words before every character."""
    n = len(points)
    stop = (points == 0x2E) | (points == 0x21) | (points == 0x3F)  # . ! ?
    ends = points == 10
    ends[1:] |= stop[:-1] & blank[1:]
    starts_word = ~blank
    starts_word[1:] &= blank[:-1]
    words_before = np.concatenate([[0], np.cumsum(starts_word)])
    cuts = np.unique(np.concatenate([[0], np.flatnonzero(ends) + 1, [n]]))
    solid = words_before[cuts[1:]] > words_before[cuts[:-1]]
    if not solid.any():
        solid[0] = True
    first = cuts[:-1][solid]
    first[0] = 0
    return first, np.append(first[1:], n), words_before


def lines(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and past-last character of every line (its break and blanks after it belong to it), hash, and words.

    Blank lines join the line before; the hash leaves out blanks at both ends.
    """
    points = W.code_points(text)
    if not len(points):
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64), np.empty(0, np.int64))
    blank = W.SPACE[np.minimum(points, 128)]
    first, last, words_before = line_places(points, blank)
    solid_at = np.flatnonzero(~blank)
    if len(solid_at):
        begin = solid_at[np.minimum(np.searchsorted(solid_at, first), len(solid_at) - 1)]
        end = solid_at[np.maximum(np.searchsorted(solid_at, last) - 1, 0)] + 1
    else:
        begin = end = first
    return first, last, W.run_hashes(points, begin, np.maximum(begin, end)), words_before[last] - words_before[first]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff: matched places, ascending in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        seen_a: dict[int, int] = {}
        seen_b: dict[int, int] = {}
        for seen, x, low, high in ((seen_a, a, a0, a1), (seen_b, b, b0, b1)):
            for i in range(low, high):
                seen[x[i]] = -1 if x[i] in seen else i
        common = [(i, seen_b[v]) for v, i in seen_a.items() if i >= 0 and seen_b.get(v, -1) >= 0]
        common.sort()
        tops: list[int] = []  # longest increasing run of places in b
        back: list[tuple[int, int]] = []
        at: list[int] = []
        for n, (_, j) in enumerate(common):
            k = bisect_left(tops, j)
            back.append((at[k - 1] if k else -1, n))
            if k == len(tops):
                tops.append(j)
                at.append(n)
            else:
                tops[k], at[k] = j, n
        chain, n = [], at[-1] if at else -1
        while n >= 0:
            chain.append(common[n])
            n = back[n][0]
        low = (a0, b0)
        for i, j in reversed(chain):
            out.append((i, j))
            todo.append((low[0], i, low[1], j))
            low = (i + 1, j + 1)
        if chain:
            todo.append((low[0], a1, low[1], b1))
    return sorted(out)


def common_blocks(a: list[int], b: list[int], words: list[int], min_words: int) -> list[int]:
    """Places in ``b`` that lie in blocks of consecutive aligned lines with at least ``min_words`` words."""
    found, block, size = [], [], 0
    last = (-2, -2)
    for i, j in [*align(a, b), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if size >= min_words:
                found += block
            block, size = [], 0
        block.append(j)
        size += words[j] if j >= 0 else 0
        last = (i, j)
    return found


class Runs(NamedTuple):
    """Words of texts laid end to end, and of every run inside a text: its first word, hash, and mark."""

    words: W.Words
    first: np.ndarray
    hash: np.ndarray
    mark: np.ndarray


def runs(texts: list[str], min_words: int) -> Runs:
    words = W.split(texts, lower=False)
    n, half = len(words.hash) - min_words + 1, max(1, min_words // 2)
    if n <= 0:
        return Runs(words, np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))
    at = np.arange(len(words.hash) - half + 1)
    mark, width, window = W.run_hashes(words.hash, at, at + half), 1, min_words - half + 1
    while width < window:
        step = min(width, window - width)
        mark, width = np.minimum(mark[:-step], mark[step:]), width + step
    first = np.flatnonzero(words.text[:n] == words.text[min_words - 1 :])
    return Runs(words, first, W.run_hashes(words.hash, first, first + min_words), mark[first])


def cut(text: str, first: list[int], min_words: int) -> tuple[int, int, int, str]:
    """Lines, lines of which all words go, words that go, and the text without the runs that begin at words ``first``.

    Blanks after a word go with it, and those before the first word of the text with that one.
    """
    points = W.code_points(text)
    if not len(points):
        return 0, 0, 0, text
    begin, end, _ = line_places(points, W.SPACE[np.minimum(points, 128)])  # without hashes, which only ``lines`` needs
    if not first:
        return len(begin), 0, 0, text
    start = W.split([text], lower=False).start
    edges = np.zeros(len(start) + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, np.array(first) + min_words, -1)
    gone = np.cumsum(edges[:-1]) > 0
    before = np.concatenate([[0], np.cumsum(gone)])
    low, high = np.searchsorted(start, begin), np.searchsorted(start, end)
    whole = (high > low) & (before[high] - before[low] == high - low)
    start[0] = 0
    turns = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=np.int8(1), append=np.int8(1)))
    places = np.append(start, len(text))[turns].tolist()
    kept = "".join(text[a:b] for a, b in zip(places[::2], places[1::2]))
    return len(begin), int(whole.sum()), int(gone.sum()), kept


_ADDED = ("text_hash", "gone", "copy", "lines", "lines_removed", "words_removed")


def repeated_runs(keyed: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, text_hash, gone``: for every text its smallest doc_id, and the first words of the runs an earlier document has."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("text_hash").to_numpy()
            for at, texts in W.groups(batch.column("text").to_pylist()):
                found = runs(texts, min_words)
                text, new = found.words.text[found.first], np.ones(len(found.first), bool)
                new[1:] = (found.mark[1:] != found.mark[:-1]) | (text[1:] != text[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.mark[new].view(np.int64)), pa.array(hashes[at + text[new]])], ["key", "text_hash"])

    spark = keyed.sparkSession
    marked = write_once(
        keyed.select("text_hash", "text").mapInArrow(marks, "key long, text_hash long")
        .groupBy("key").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b")).filter("a < b").select("key"), "marks")
    bits, filled = _bit_set(marked)
    shared = spark.sparkContext.broadcast(filled)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = shared.value
        for batch in batches:
            ids, hashes = batch.column("doc_id").to_numpy(), batch.column("text_hash").to_numpy()
            for at, texts in W.groups(batch.column("text").to_pylist()):
                found = runs(texts, min_words)
                there = np.ones(len(found.first), bool)
                for place in _places(found.mark, bits):
                    there &= (present[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
                first = found.first[there]
                owner, sizes = np.unique(found.words.text[first], return_counts=True)
                bounds = W.offsets(found.words, len(texts))
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[at + owner]), pa.array(hashes[at + owner]),
                    pa.ListArray.from_arrays(ends, pa.array((first - np.repeat(bounds[owner], sizes)).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(found.hash[there].view(np.int64))),
                ], ["doc_id", "text_hash", "first", "hashes"])

    looked = write_once(
        keyed.select("doc_id", "text_hash", "text")
        .mapInArrow(look_up, "doc_id long, text_hash long, first array<int>, hashes array<long>"), "runs")
    holder = write_once(
        looked.select("doc_id", F.explode("hashes").alias("hash")).groupBy("hash")
        .agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("last")).filter("holder < last").select("hash", "holder"),
        "first_runs")  # its own table: a run of very many documents can then be split in the join
    # the first document of every text; its later copies go whole and need no look-up
    texts = keyed.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"))
    own = looked.join(texts, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    met = (
        own.select("doc_id", "text_hash", F.inline(F.arrays_zip("first", F.col("hashes").alias("hash"))))
        .join(holder, "hash").filter("holder < doc_id")
        .groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("first")).alias("gone"))
    )
    return texts.join(met, ["doc_id", "text_hash"], "left").select("doc_id", "text_hash", "gone")


def remove_repeated(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` with repeated passages deleted from ``text``, and ``lines, lines_removed, words_removed``.

    Every run of ``min_words`` words that a document of smaller doc_id has is deleted, also inside lines.
    Words are parted by blanks and compared as written.  Rows of one doc_id are not compared with
    each other, and rows without one stay whole.  Null stays null, a text that loses all its
    words becomes empty.  ``lines_removed`` counts lines that lose all their words.
    """
    docs = docs.drop(*_ADDED)  # new columns replace any of their names
    keyed = docs.withColumn("text_hash", F.xxhash64("text"))
    known = repeated_runs(
        keyed.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text_hash", "text"),
        min_words).withColumn("copy", F.lit(False))
    others = [c for c in docs.columns if c != "text"]
    counts = ["lines", "lines_removed", "words_removed"]

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, gone, copy in zip(*(batch.column(c).to_pylist() for c in ("text", "gone", "copy"))):
                if text is None:
                    rows.append((0, 0, 0, None))
                    continue
                if copy:
                    gone = range(len(W.split([text], lower=False).start) - min_words + 1)
                rows.append(cut(text, list(gone or ()), min_words))
            out = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())],
                [*others, *counts, "text"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    # the other side has a row for every text: both are shuffled at any size
    joined = keyed.join(write_once(known, "runs_gone").hint("merge"), ["doc_id", "text_hash"], "left")
    copy = F.coalesce("copy", F.col("text").isNotNull() & F.col("doc_id").isNotNull()).alias("copy")
    out = joined.select(*others, "text", "gone", copy).mapInArrow(
        delete, f"{kinds}, lines long, lines_removed long, words_removed long, text string")
    return out.select(*docs.columns, *counts)
