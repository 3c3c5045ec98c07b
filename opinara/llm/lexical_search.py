"""Ranked lexical search of every query item over all documents by blocked dense products.

The distinct terms of some items are a compact vocabulary.  Tiles of item weights (items x
terms) are multiplied by tiles of document impacts (terms x documents) in float64; a tile
is as wide as keeps its sums below 2**53, so every partial sum is an exact integer, and tiles
are added up in 64-bit integers.  A task keeps the ``k`` best documents of each item, equal
scores by ascending doc_id, so ties lose nothing; the tasks' lists are merged in two steps.

Items are taken in blocks of bounded size, each of which passes over all documents.  Terms
are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W

BLOCK_ITEMS, BLOCK_CHARS = 1024, 1 << 20
ITEM_TILE, DOC_TILE, TERM_TILE = 256, 512, 4096
TILE_CELLS = 1 << 21  # items x terms of one tile of items
IMPACT = 1_000_000  # impacts stay below this
SALTS = 64


class Block:
    """Items with their distinct terms: numbers into the block's vocabulary of ascending hashes."""

    def __init__(self, item_ids: pa.Array, texts: list[str | None]):
        words = W.split([t or "" for t in texts], W.NOT_ALNUM)
        # rows of one item_id are one item
        self.item_ids = item_ids.unique()
        number = pc.index_in(item_ids, self.item_ids).to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocabulary, term = np.unique(words.hash, return_inverse=True)
        size = max(1, len(self.vocabulary))
        held = np.unique(number[words.text] * size + term)
        self.item, self.term = held // size, held % size

    def tiles(self, weights: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """``(first item, local number by term or -1, weights)`` of runs of items with few terms together."""
        out, first, n = [], 0, len(self.item_ids)
        bounds = np.searchsorted(self.item, np.arange(n + 1))
        while first < n:
            last = min(n, first + ITEM_TILE)
            while last > first + 1 and (last - first) * len(np.unique(self.term[bounds[first] : bounds[last]])) > TILE_CELLS:
                last = first + (last - first) // 2
            item, term = self.item[bounds[first] : bounds[last]], self.term[bounds[first] : bounds[last]]
            own = np.unique(term)
            local = np.full(len(self.vocabulary), -1, np.int32)
            local[own] = np.arange(len(own))
            dense = np.zeros((last - first, len(own)))
            dense[item - first, local[term]] = weights[term]
            out.append((first, local, dense))
            first = last
        return out


def _blocks(items: DataFrame) -> Iterator[Block]:
    items = items.select("item_id", "text")
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    of = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for number in range(blocks):
        rows = items.filter(of == number).toArrow()
        if len(rows):
            yield Block(rows["item_id"].combine_chunks(), rows["text"].to_pylist())


def _found(texts: list[str], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and ``text, term, count`` of the vocabulary's terms in each."""
    words = W.split(texts, W.NOT_ALNUM)
    n_words = np.diff(W.offsets(words, len(texts)))
    at = np.searchsorted(vocabulary, words.hash)
    at[at == len(vocabulary)] = 0
    hit = vocabulary[at] == words.hash if len(vocabulary) else np.zeros(len(at), bool)
    size = max(1, len(vocabulary))
    held, tf = np.unique(words.text[hit] * size + at[hit], return_counts=True)
    return n_words, held // size, held % size, tf


def term_counts(docs: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms in all, and documents per term of the block's vocabulary."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(block.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary.value) + 2, np.int64)
        for batch in batches:
            for _, texts in W.groups(batch.column("text").to_pylist()):
                n_words, _, term, _ = _found(texts, vocabulary.value)
                df[:-2] += np.bincount(term, minlength=len(df) - 2)
                df[-2:] += [(n_words > 0).sum(), n_words.sum()]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some), "n": pa.array(df[some])})

    sums = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(block.vocabulary) + 2, np.int64)
    out[sums["term"].to_numpy()] = sums["n"].to_numpy()
    return int(out[-2]), int(out[-1]), out[:-2]


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    some, which = np.unique(df, return_inverse=True)
    each = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in some.tolist()]
    return np.array(each, np.int64)[which] if len(df) else np.empty(0, np.int64)


def impacts(tf: np.ndarray, n_words: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of ``tf`` occurrences in a document of ``n_words``; lengths in whole numbers of any size."""
    some, which = np.unique(n_words, return_inverse=True)
    m = np.array([10 + 90 * n * n_docs // n_terms for n in some.tolist()], np.int64)[which] if len(some) else n_words
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class TopK:
    """The k best ``(item, score, document)`` of each item; a null document comes last among equal scores."""

    def __init__(self, k: int, n_items: int):
        self.k, self.item = k, np.empty(0, np.int64)
        self.score, self.doc, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        self.least = np.ones(n_items, np.int64)  # scores below cannot enter

    def add(self, first: int, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """``scores`` of items from ``first`` on (rows) and documents (columns)."""
        rows, columns = np.nonzero(scores >= self.least[first : first + len(scores), None])
        if not len(rows):
            return
        item = np.append(self.item, rows + first)
        score, doc = np.append(self.score, scores[rows, columns]), np.append(self.doc, doc[columns])
        null = np.append(self.null, null[columns])
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        nth = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[nth < self.k]
        self.item, self.score, self.doc, self.null = item[nth < self.k], score[keep], doc[keep], null[keep]
        full = np.flatnonzero(nth[nth < self.k] == self.k - 1)
        self.least[self.item[full]] = self.score[full]


def _search(docs: DataFrame, block: Block, k: int, item_type) -> DataFrame:
    n_docs, n_terms, df = term_counts(docs, block)
    weights = term_weights(n_docs, df)
    width = max(1, min(TERM_TILE, (1 << 53) // (IMPACT * max(1, int(weights.max(initial=0))))))
    shared = docs.sparkSession.sparkContext.broadcast((block, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = shared.value
        tiles, top = block.tiles(weights), TopK(k, len(block.item_ids))
        for batch in batches:
            for at, texts in W.groups(batch.column("text").to_pylist()):
                ids = batch.column("doc_id").slice(at, len(texts))
                doc, null = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
                n_words, text, term, tf = _found(texts, block.vocabulary)
                impact = impacts(tf, n_words[text], n_docs, n_terms)
                for start in range(0, len(texts), DOC_TILE):
                    a, b = np.searchsorted(text, [start, start + DOC_TILE])
                    stop = min(len(texts), start + DOC_TILE)
                    for first, local, dense in tiles:
                        own = local[term[a:b]]
                        some, place = np.unique(own[own >= 0], return_inverse=True)  # terms that these documents hold
                        column, value = text[a:b][own >= 0] - start, impact[a:b][own >= 0]
                        scores = np.zeros((len(dense), stop - start), np.int64)
                        for low in range(0, len(some), width):
                            mine = (place >= low) & (place < low + width)
                            cells = np.zeros((min(width, len(some) - low), stop - start))
                            cells[place[mine] - low, column[mine]] = value[mine]
                            scores += (dense[:, some[low : low + width]] @ cells).astype(np.int64)
                        top.add(first, scores, doc[start:stop], null[start:stop])
        yield pa.RecordBatch.from_arrays([
            block.item_ids.take(pa.array(top.item)), pa.array(top.doc, mask=top.null), pa.array(top.score)
        ], ["item_id", "doc_id", "score"])

    ddl = f"item_id {item_type.simpleString()}, doc_id long, score long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, ddl)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 for each item.

    Equal scores rank by ascending doc_id (null last).  Rows of one item_id are one item with
    the terms of all; rows of one doc_id are several documents.  Null and empty texts have no
    terms; without any term in the items or documents there are no rows.  Other columns are
    not read.
    """
    item_type = items.schema["item_id"].dataType
    found = docs.sparkSession.createDataFrame([], f"item_id {item_type.simpleString()}, doc_id long, score long")
    for block in _blocks(items):
        found = found.union(_search(docs, block, k, item_type))
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = Window.partitionBy("item_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS))).orderBy(*best)
    some = found.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= k)
    whole = Window.partitionBy("item_id").orderBy(*best)
    return (
        some.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
