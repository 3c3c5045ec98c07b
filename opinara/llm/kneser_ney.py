"""Interpolated modified Kneser-Ney bigram model over words, counted in Spark.

Tokens are cut into chunks of a few million; a chunk numbers its distinct words and pairs
of words by hash.  Two exchanges make the model:

* pairs: each shard of the hash range merges the sorted hashes of all chunks into one sorted
  array with counts, writes it to a file of its own that it maps into memory, and
  answers every chunk, pair by pair: count in training, and which chunk is the one to add
  the pair to the statistics of its words;
* words: the same for words, with their counts, the numbers of pairs they begin by count
  (once, twice, more often), and the number of different words before them.

A chunk then has all it needs to score its texts.  Hashes travel sorted, as compressed
differences, so an exchange moves a few bytes for each distinct pair.
"""

from __future__ import annotations

import math
import os
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from . import words as W

BITS = 52  # of a hash; two of 10**9 pairs share one with a probability of about 2e-7 each
CHUNK_WORDS = 1_000_000
SHARD_KEYS = 2_000_000
_BOUNDARY = np.uint64(1)  # stands for the word before the first; no word has so small a hash
_END = np.uint64(2)


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers, byte plane by byte plane, compressed."""
    values = np.ascontiguousarray(values, "<u8")
    planes = values.view(np.uint8).reshape(-1, 8).T
    used = max((i + 1 for i in range(8) if planes[i].any()), default=int(len(values) > 0))
    return bytes([used]) + zstandard.compress(np.ascontiguousarray(planes[:used]).tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    used = blob[0]
    raw = np.frombuffer(zstandard.decompress(blob[1:]), np.uint8)
    if not used:
        return np.empty(0, np.uint64)
    planes = raw.reshape(used, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :used] = planes.T
    return out.view("<u8").ravel()


def _word_keys(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)) | np.uint64(4)


def _pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return W.mix(before * np.uint64(W.BASE) + W.mix(word)) >> np.uint64(64 - BITS)


class Chunk(NamedTuple):
    """Some texts: ids, tokens (with the end) of each, whether they train, and every token's word number."""

    n_tokens: np.ndarray
    trains: np.ndarray
    words: np.ndarray  # distinct word keys, ascending; the end among them
    tokens: np.ndarray  # places in ``words``, text after text, an end after each

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pair keys, ascending; the pair of every token; for each pair, the places of its words
        (of the word before: the number of words for none)."""
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.n_tokens) - self.n_tokens] = len(self.words)
        keys = _pair_keys(np.append(self.words, _BOUNDARY)[before], self.words[self.tokens])
        distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
        return distinct, which, before[first], self.tokens[first]

    def training_tokens(self) -> np.ndarray:
        return np.repeat(self.trains, self.n_tokens)


_CHUNKS = "chunk long, doc_id array<long>, n_tokens array<long>, trains array<boolean>, words binary, numbers binary, ranks binary"


def _chunks(docs: DataFrame) -> DataFrame:
    """Rows of whole texts with about CHUNK_WORDS words (a longer text has a row of its own)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, ids, trains, parts, size = TaskContext.get().partitionId() << 32, [], [], [], 0

        def row() -> pa.RecordBatch:
            flat = np.concatenate([np.append(x, _END) for x in parts])
            words, which, n = np.unique(flat, return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")  # frequent words get small numbers, which compress well
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            return pa.RecordBatch.from_pylist([{
                "chunk": chunk, "doc_id": ids, "n_tokens": [len(x) + 1 for x in parts], "trains": trains,
                "words": pack(np.diff(words, prepend=np.uint64(0))), "numbers": pack(rank[which]), "ranks": pack(order),
            }], pa.schema([
                ("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
                ("trains", pa.list_(pa.bool_())), ("words", pa.binary()), ("numbers", pa.binary()), ("ranks", pa.binary())]))

        for batch in batches:
            doc_ids, train = batch.column("doc_id").to_pylist(), batch.column("trains").to_pylist()
            for at, texts in W.groups(batch.column("text").to_pylist()):
                words = W.split(texts)
                keys, cuts = _word_keys(words.hash), W.offsets(words, len(texts))
                for i in range(len(texts)):
                    ids.append(doc_ids[at + i])
                    trains.append(train[at + i])
                    parts.append(keys[cuts[i] : cuts[i + 1]])
                    size += len(parts[-1]) + 1
                    if size >= CHUNK_WORDS:
                        yield row()
                        chunk, ids, trains, parts, size = chunk + 1, [], [], [], 0
        if parts:
            yield row()

    return docs.mapInArrow(make, _CHUNKS)


def _open(row: dict) -> Chunk:
    words = np.cumsum(unpack(row["words"]), dtype=np.uint64)
    tokens = unpack(row["ranks"])[unpack(row["numbers"])].astype(np.int64) if len(words) else np.empty(0, np.int64)
    return Chunk(np.array(row["n_tokens"], np.int64), np.array(row["trains"], bool), words, tokens)


def _shards(keys: np.ndarray, n: int) -> np.ndarray:
    """Cuts of ascending keys into ``n`` equal parts of the hash range."""
    edges = [(i << BITS) // n for i in range(n)] + [1 << BITS]
    return np.searchsorted(keys, np.array(edges, np.uint64))


class Mapped:
    """Sorted hashes with columns of numbers in a file of the worker's own, mapped into memory while in use."""

    def __init__(self, keys: np.ndarray, columns: list[np.ndarray]):
        self.folder = tempfile.TemporaryDirectory()
        self.arrays = []
        for i, x in enumerate([keys, *columns]):
            path = os.path.join(self.folder.name, str(i))
            np.ascontiguousarray(x).tofile(path)
            self.arrays.append(np.memmap(path, x.dtype, "r") if len(x) else x)

    def find(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.arrays[0], keys)

    def close(self) -> None:
        self.arrays = []
        self.folder.cleanup()


def _exchange(sent: DataFrame, n_columns: int, owners: bool) -> DataFrame:
    """Answer rows ``chunk, shard, totals`` for rows ``shard, chunk, keys, columns``.

    ``totals`` are the sums of each column over all chunks for the keys sent; with ``owners`` a last
    column marks the keys whose first chunk this is.
    """

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        chunks = rows.column("chunk").to_pylist()
        keys = [np.cumsum(unpack(x.as_py()), dtype=np.uint64) for x in rows.column("keys")]
        sent = [[unpack(x) for x in row] for row in rows.column("columns").to_pylist()]
        flat = np.concatenate(keys)
        distinct, which = np.unique(flat, return_inverse=True)
        totals = [np.bincount(which, np.concatenate([row[i] for row in sent]), len(distinct)).astype(np.uint64) for i in range(n_columns)]
        if owners:
            first = np.full(len(distinct), len(chunks), np.uint64)
            ends = np.cumsum(list(map(len, keys)))
            for nth in np.argsort(chunks, kind="stable")[::-1].tolist():
                first[which[ends[nth] - len(keys[nth]) : ends[nth]]] = nth
            totals.append(first)
        del flat, which
        table = Mapped(distinct, totals)
        out = []
        for nth, mine in enumerate(keys):
            place = table.find(mine)
            got = [x[place] for x in table.arrays[1 : n_columns + 1]]
            if owners:
                got.append((table.arrays[-1][place] == nth).astype(np.uint64))
            out.append({"chunk": chunks[nth], "shard": key[0].as_py(), "totals": [pack(x) for x in got]})
        table.close()
        return pa.Table.from_pylist(out, pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("totals", pa.list_(pa.binary()))]))

    return sent.groupBy("shard").applyInArrow(merge, "chunk long, shard int, totals array<binary>")


_SENT = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("columns", pa.list_(pa.binary()))])
_SENT_DDL = "shard int, chunk long, keys binary, columns array<binary>"


def _send(chunk: int, keys: np.ndarray, columns: list[np.ndarray], n: int) -> Iterator[dict]:
    cuts = _shards(keys, n)
    for shard, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if b > a:
            yield {"shard": shard, "chunk": chunk, "keys": pack(np.diff(keys[a:b], prepend=np.uint64(0))), "columns": [pack(x[a:b]) for x in columns]}


def _received(rows: pa.Table, n_columns: int) -> list[np.ndarray]:
    rows = sorted(rows.select(["shard", "totals"]).to_pylist(), key=lambda r: r["shard"])
    return [np.concatenate([np.empty(0, np.uint64), *(unpack(r["totals"][i]) for r in rows)]) for i in range(n_columns)]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams seen one to four times."""
    if min(n1, n2, n3) == 0:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.1), i + 0.9) for i, d in enumerate(found))


def perplexity_table(docs: DataFrame, trains: Column) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Tokens are the white-space words (A-Z in lower case) and one end per text; null texts
    are empty.  Texts with ``trains`` true are learnt from.  ``score`` is log10 of the
    model's probability: pairs of words interpolated with the share of different
    predecessors, that with one over the number of words known, and one for all others.
    ``base_score`` sums ``log10((c + 1) / (N + V + 1))``.  With nothing learnt, every
    token has probability one.
    """
    spark = docs.sparkSession
    chunks = write_once(_chunks(docs.select(
        F.col("doc_id").cast("long"), F.coalesce(trains, F.lit(False)).alias("trains"), "text")), "chunks")
    total = chunks.select(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    n_shards = max(-(-total // SHARD_KEYS), min(spark.sparkContext.defaultParallelism, total // 50_000), 1)

    def send_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _open(row)
                keys, which, _, _ = chunk.pairs()
                count = np.bincount(which[chunk.training_tokens()], minlength=len(keys))
                yield pa.RecordBatch.from_pylist(list(_send(row["chunk"], keys, [count], n_shards)), _SENT)

    pairs = write_once(_exchange(chunks.mapInArrow(send_pairs, _SENT_DDL), 1, owners=True), "pair_counts")

    def send_words(key: tuple, own: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in own.to_pylist():
            chunk = _open(row)
            _, _, before, word = chunk.pairs()
            count, owner = _received(answers, 2)
            mine = (owner == 1) & (count > 0)
            size = len(chunk.words) + 1
            used = np.bincount(chunk.tokens[chunk.training_tokens()], minlength=size)
            starts = np.bincount(before[mine], count[mine], size)
            begins = [np.bincount(before[mine & test], minlength=size) for test in (count == 1, count == 2, count > 2)]
            follows = np.bincount(word[mine], minlength=size)
            of_counts = [int((mine & (count == c)).sum()) for c in (1, 2, 3, 4)]
            columns = [used, follows, starts.astype(np.int64), *begins]
            keys = np.append(_BOUNDARY, chunk.words)
            out += _send(row["chunk"], keys, [np.append(x[-1], x[:-1]) for x in columns], n_shards)
            out.append({"shard": -1, "chunk": row["chunk"], "keys": pack(np.array(of_counts, np.uint64)), "columns": []})
        return pa.Table.from_pylist(out, _SENT)

    sent = write_once(chunks.groupBy("chunk").cogroup(pairs.groupBy("chunk")).applyInArrow(send_words, _SENT_DDL), "words_sent")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            four = np.zeros(4, np.int64)
            for x in batch.column("keys").to_pylist():
                four += unpack(x).astype(np.int64)
            yield pa.RecordBatch.from_pydict({f"n{i + 1}": pa.array([x]) for i, x in enumerate(four)})

    row = sent.filter("shard = -1").mapInArrow(sums, "n1 long, n2 long, n3 long, n4 long").groupBy().sum().first()
    d_pair = discounts(*(x or 0 for x in row))
    words = write_once(_exchange(sent.filter("shard >= 0"), 6, owners=True), "word_counts")

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(8, np.int64)
            for totals in batch.column("totals").to_pylist():
                used, follows, owner = unpack(totals[0]), unpack(totals[1]), unpack(totals[6]) == 1
                f = follows[owner]
                out += [int(used[owner].sum()), int((used[owner] > 0).sum()), int(f.sum()), int((f > 0).sum()),
                        *(int((f == c).sum()) for c in (1, 2, 3, 4))]
            yield pa.RecordBatch.from_pydict({f"x{i}": pa.array([x]) for i, x in enumerate(out)})

    row = words.mapInArrow(summary, ", ".join(f"x{i} long" for i in range(8))).groupBy().sum().first()
    all_tokens, vocabulary, kinds, following, *of_counts = (x or 0 for x in row)
    d_word = discounts(*of_counts)
    once_or_twice = of_counts[0] + of_counts[1]
    lower_mass = of_counts[0] * d_word[0] + of_counts[1] * d_word[1] + (following - once_or_twice) * d_word[2]

    def score(key: tuple, own: pa.Table, answers: pa.Table) -> pa.Table:
        of_pairs, of_words = (answers.filter(pc.equal(answers.column("kind"), k)) for k in (0, 1))
        out = [pa.table([[]] * len(_RESULT), schema=_RESULT)]
        for row in own.to_pylist():
            chunk = _open(row)
            _, which, before, word = chunk.pairs()
            count, _ = _received(of_pairs, 2)
            # the boundary last, as in pairs()
            used, follows, starts, once, twice, more, _ = (np.append(x[1:], x[:1]).astype(float) for x in _received(of_words, 7))
            lower = np.ones(len(follows))
            if kinds:
                lower = (follows - _discount(follows, d_word) + lower_mass / (vocabulary + 1)) / kinds
            spare = (d_pair[0] * once + d_pair[1] * twice + d_pair[2] * more)[before]
            begun = starts[before]
            seen = count - _discount(count, d_pair) + spare * lower[word]
            p = np.where(begun > 0, seen / np.maximum(begun, 1), lower[word])
            base = np.log10(used + 1) - math.log10(all_tokens + vocabulary + 1)
            begins = np.cumsum(chunk.n_tokens) - chunk.n_tokens
            known = (used > 0)[chunk.tokens].astype(np.int64)
            out.append(pa.table([
                pa.array(row["doc_id"], pa.int64()), chunk.n_tokens, np.add.reduceat(known, begins),
                np.full(len(begins), all_tokens, np.int64), np.add.reduceat(base[chunk.tokens], begins),
                np.add.reduceat(np.log10(p)[which], begins),
            ], schema=_RESULT))
        return pa.concat_tables(out)

    answers = pairs.withColumn("kind", F.lit(0)).union(words.withColumn("kind", F.lit(1)))
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64())])


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.select([counts == 0, counts == 1, counts == 2], [0, d[0], d[1]], d[2])
