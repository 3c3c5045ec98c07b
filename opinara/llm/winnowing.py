"""Benchmark decontamination by winnowing.

Of every ``window`` consecutive k-gram hashes the smallest (rightmost on ties) is a
fingerprint, so two texts that share ``k + window - 1`` consecutive words share a
fingerprint inside them.  Documents and benchmark meet on fingerprints; every meeting is
extended to the longest common run and counts when the run is long enough.  Items shorter
than that are one k-gram of their own length, looked up at every place.

Documents are read once.  A bit set of the benchmark's fingerprints (at most 2**28 bits,
whatever the benchmark's size) goes to the workers and drops nearly all documents; texts
of the others are written and joined with their items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from . import words as W

MAX_BITS = 28


def fingerprints(hashes: np.ndarray, text: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints of texts laid end to end (``text``: each word's text)."""
    grams = W.grams(hashes, k)
    if not len(grams):
        return np.empty(0, np.int64), grams
    inside = text[: len(grams)] == text[k - 1 :]
    value = np.where(inside, grams, np.uint64(2**64 - 1))
    padded = np.concatenate([value, np.full(window - 1, 2**64 - 1, np.uint64)])
    least = value.copy()
    for i in range(1, window):
        np.minimum(least, padded[i : i + len(value)], out=least)
    place = np.zeros(len(value), np.int64)
    for i in range(window):
        place[padded[i : i + len(value)] == least] = i
    places = np.unique(np.minimum(place + np.arange(len(value)), len(value) - 1))
    places = places[inside[places]]
    return places, grams[places]


def keys_of(words: W.Words, k: int, window: int, short: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and key of every place to look up: fingerprints, and all n-grams of the short lengths."""
    places, keys = fingerprints(words.hash, words.text, k, window)
    texts, found = [words.text[places]], [keys]
    for n in short:
        grams = W.grams(words.hash, n)
        inside = words.text[: len(grams)] == words.text[n - 1 :] if len(grams) else np.empty(0, bool)
        texts.append(words.text[: len(grams)][inside])
        found.append(grams[inside])
    return np.concatenate(texts), np.concatenate(found)


def _common_run(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal values at the beginning of both, looked at in growing steps."""
    n, step = min(len(a), len(b)), 16
    for at in range(n):
        low = (1 << at) * step - step
        if low >= n:
            break
        high = min(n, (1 << (at + 1)) * step - step)
        differ = np.flatnonzero(a[low:high] != b[low:high])
        if len(differ):
            return low + int(differ[0])
    return n


def hit_words(doc: np.ndarray, item: np.ndarray, k: int, window: int) -> np.ndarray:
    """Which words of ``doc`` lie in a run shared with ``item`` of ``k + window - 1`` words, or the whole item if shorter."""
    span = min(k + window - 1, len(item))
    hit = np.zeros(len(doc), bool)
    if not span:
        return hit
    if span < k + window - 1:
        starts = np.flatnonzero(W.grams(doc, span) == W.grams(item, span)[0])
        for p in starts.tolist():
            hit[p : p + span] = True
        return hit
    none = np.zeros(1, np.int64)
    of_doc, doc_keys = fingerprints(doc, np.repeat(none, len(doc)), k, window)
    of_item, item_keys = fingerprints(item, np.repeat(none, len(item)), k, window)
    order = np.argsort(item_keys, kind="stable")
    low = np.searchsorted(item_keys[order], doc_keys, "left")
    high = np.searchsorted(item_keys[order], doc_keys, "right")
    reached: dict[int, int] = {}  # by diagonal: end of the run looked at last
    for i in np.flatnonzero(high > low).tolist():
        p = int(of_doc[i])
        for q in of_item[order[low[i] : high[i]]].tolist():
            if p < reached.get(p - q, 0):
                continue
            before = _common_run(doc[:p][::-1], item[:q][::-1])
            after = _common_run(doc[p:], item[q:])
            reached[p - q] = p + after
            if before + after >= span:
                hit[p - before : p + after] = True
    return hit


def _benchmark_keys(benchmark: DataFrame, k: int, window: int, separators: np.ndarray) -> DataFrame:
    """``item_hash`` (of the item's word sequence), ``key``, ``n_words`` for every item with words."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in W.groups(batch.column("text").to_pylist()):
                words = W.split(texts, separators)
                bounds = W.offsets(words, len(texts))
                for i, text in enumerate(texts):
                    mine = words.hash[bounds[i] : bounds[i + 1]]
                    n = len(mine)
                    if not n:
                        continue
                    keys = W.grams(mine, n) if n < k + window - 1 else np.unique(fingerprints(mine, np.zeros(n), k, window)[1])
                    yield pa.RecordBatch.from_pydict({
                        "item_id": pa.array([batch.column("item_id")[at + i].as_py()] * len(keys), pa.string()),
                        "key": pa.array(keys.view(np.int64)),
                        "n_words": pa.array([n] * len(keys), pa.int64()),
                        "text": pa.array([text] * len(keys), pa.string()),
                    })

    items = benchmark.select(F.col("item_id").cast("string"), "text")
    return items.mapInArrow(make, "item_id string, key long, n_words long, text string")


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of every key, from its two ends."""
    return keys >> np.uint64(64 - bits), keys & np.uint64((1 << bits) - 1)


def _bit_set(keys: DataFrame) -> tuple[int, np.ndarray]:
    """Bits in use, 256 or more a key up to the limit, and the set of both bits of every key, joined in Spark."""
    bits = min(MAX_BITS, max(22, (256 * keys.count()).bit_length()))
    both = F.array(F.shiftrightunsigned("key", 64 - bits), F.col("key").bitwiseAND(F.lit((1 << bits) - 1)))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit")
    rows = (
        keys.select(F.explode(both).alias("place")).select(F.shiftright("place", 6).alias("word"), bit)
        .groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()  # at most 2**22 rows
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["word"].to_numpy()] = rows["bit"].to_numpy().view(np.uint64)
    return bits, out


def contamination(
    docs: DataFrame, benchmark: DataFrame, span: int = 13, k: int = 8, separators: np.ndarray = W.NOT_ALNUM
) -> DataFrame:
    """One row per document row: its columns but ``text``, ``n_words``, ``n_hit`` and ``item_ids``.

    A document word is hit if it lies in ``span`` consecutive words that also stand in an
    item, or in a whole item of fewer words.  ``item_ids`` are the distinct items found,
    as sorted strings.  Null and empty texts have no words; rows of one doc_id stay apart;
    items without words find nothing, and items without an id hit without being named.
    """
    window = span - k + 1
    spark = docs.sparkSession
    items = write_once(_benchmark_keys(benchmark, k, window, separators), "benchmark_keys")
    bits, filled = _bit_set(items.select("key").distinct())
    short = sorted(r[0] for r in items.filter(F.col("n_words") < span).select("n_words").distinct().collect())  # < span rows
    shared = spark.sparkContext.broadcast(filled)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, row = shared.value, TaskContext.get().partitionId() << 34
        for batch in batches:
            for at, texts in W.groups(batch.column("text").to_pylist()):
                words = W.split(texts, separators)
                owner, keys = keys_of(words, k, window, short)
                there = np.ones(len(keys), bool)
                for place in _places(keys, bits):
                    there &= (present[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
                owner, keys = owner[there], keys[there]
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(len(texts) + 1))
                keys = keys[order].view(np.int64)
                lists = [np.unique(keys[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(row + np.arange(len(texts))),
                    "doc_id": batch.column("doc_id").slice(at, len(texts)),
                    "n_words": pa.array(np.diff(W.offsets(words, len(texts))).astype(np.int64)),
                    "keys": pa.array(lists, pa.list_(pa.int64())),
                    "text": pa.array([t if len(x) else None for t, x in zip(texts, lists)], pa.string()),
                })
                row += len(texts)

    ddl = "row long, doc_id long, n_words long, keys array<long>, text string"
    looked = write_once(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(look_up, ddl), "looked_up")
    maybe = looked.filter(F.size("keys") > 0)
    met = (
        maybe.select("row", F.explode("keys").alias("key")).join(items.select("key", "item_id", "text"), "key")
        .select("row", "item_id", F.col("text").alias("item")).distinct()
        .groupBy("row").agg(F.collect_list(F.struct("item_id", "item")).alias("items"))  # a document's own items
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc in batch.to_pylist():
                items_ = doc["items"]
                words = W.split([doc["text"], *(x["item"] for x in items_)], separators)
                bounds = W.offsets(words, len(items_) + 1)
                text = words.hash[: bounds[1]]
                hit, found = np.zeros(len(text), bool), set()
                for i, x in enumerate(items_, 1):
                    one = hit_words(text, words.hash[bounds[i] : bounds[i + 1]], k, window)
                    if one.any():
                        hit |= one
                        found.add(x["item_id"])
                rows.append({"row": doc["row"], "n_hit": int(hit.sum()), "item_ids": sorted(found - {None})})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("row", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string()))]))

    hits = maybe.select("row", "text").join(met, "row").mapInArrow(verify, "row long, n_hit long, item_ids array<string>")
    return looked.select("row", "doc_id", "n_words").join(hits, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def contaminated() -> Column:
    """At least a twentieth of the words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
