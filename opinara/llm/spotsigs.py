"""SpotSigs fingerprints: chains of content words that follow common words.

A signature is a common word (anchor) with the next ``CHAIN`` content words; a fingerprint is
the set of a text's signatures as eight hex digits each, ascending.  In a stretch without
anchors every eighth word since the last one stands in as an anchor, so tables and texts of
other languages have fingerprints too; a text too short for a chain has one signature.

Fingerprints are compared by Jaccard similarity, partitioned by set length: sets whose
lengths are more than one partition apart cannot reach the threshold.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from . import words as W

# Common words of four languages.
ANCHORS = (
    "the a an of in to is was are and that it for with as by this be on at from or have not but he they you "
    "le la les un une des du de et est que en pour dans sur pas avec il au par ce qui "
    "der die das und ist ein eine von mit den zu nicht auf sich im dem für auch es als "
    "el los las del una y al con se no lo su como más o si"
).split()
CHAIN = 3
GAP = 8


def signatures(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct 32-bit signatures of each text."""
    words = W.split(texts, W.NOT_ALNUM)
    h, text, n = words.hash, words.text, len(words.hash)
    bounds = W.offsets(words, len(texts))
    if not n:
        return [np.empty(0, np.uint32)] * len(texts)
    common = np.isin(h, W.split([" ".join(ANCHORS)]).hash)
    first = np.ones(n, bool)
    first[1:] = text[1:] != text[:-1]
    since = np.arange(n) - np.maximum.accumulate(np.where(common | first, np.arange(n), 0))
    anchor = common | (since % GAP == 0)
    content = np.append(np.flatnonzero(~common), np.full(CHAIN, n))
    at = np.flatnonzero(anchor)
    nth = np.searchsorted(content, at, "right")
    last = content[nth + CHAIN - 1]
    ok = last < n
    at, nth, last = at[ok], nth[ok], last[ok]
    ok = text[last] == text[at]
    at, nth = at[ok], nth[ok]
    value = h[at]
    for i in range(CHAIN):
        value = value * np.uint64(W.BASE) + h[content[nth + i]]
    value = (W.mix(value) >> np.uint64(32)).astype(np.uint32)
    cuts = np.searchsorted(text[at], np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        mine = np.unique(value[cuts[i] : cuts[i + 1]])
        if not len(mine) and bounds[i + 1] > bounds[i]:
            whole = h[bounds[i] : bounds[i + 1]]
            mine = (W.grams(whole, len(whole)) >> np.uint64(32)).astype(np.uint32)
        out.append(mine)
    return out


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def length_partition(n: int, threshold: float) -> int:
    """Sets of sizes two partitions apart differ by more than the threshold in length alone."""
    return int(math.floor(math.log(n) / math.log(1 / threshold))) if n else -1


def jaccard(a: np.ndarray, b: np.ndarray, threshold: float = 0.0) -> float:
    """Similarity of two fingerprints; 0 for pairs that by their lengths alone stay under ``threshold``."""
    low, high = sorted((len(a), len(b)))
    if not high:
        return 1.0
    if low < threshold * high:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (low + high - both)


def _neighbours(docs: DataFrame, order: str, n_buckets: int) -> DataFrame:
    """Rows in ``n_buckets`` ranges of ``order``, each row that opens a range also after the range above it.

    The first row of all comes after the last as well.  Only ``order`` is read to find the
    ranges; the result of that has one row per range.
    """
    edges = sorted(set(docs.approxQuantile(order, [i / n_buckets for i in range(1, n_buckets)], 0.1 / n_buckets))) if n_buckets > 1 else []
    if edges:
        numbered = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol=order, outputCol="bucket").transform(docs)
        numbered = numbered.withColumn("bucket", F.col("bucket").cast("int"))
    else:
        numbered = docs.withColumn("bucket", F.lit(0))
    heads = sorted(tuple(r) for r in numbered.groupBy("bucket").agg(F.max(order)).collect())  # one row per range
    target = [(head, heads[i + 1][0] if i + 1 < len(heads) else heads[0][0]) for i, (_, head) in enumerate(heads)]
    to = docs.sparkSession.createDataFrame(target, f"{order} double, also int")
    own = F.struct(F.col("bucket").alias("at"), F.lit(False).alias("copy"))
    copy = F.struct(F.col("also").alias("at"), F.lit(True).alias("copy"))
    places = F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, copy))
    rows = numbered.join(F.broadcast(to), order, "left").withColumn("place", F.explode(places))
    return rows.repartitionById(len(edges) + 1, F.col("place.at")).withColumn("copy", F.col("place.copy"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of an edited one, whose last third begins the next text instead.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    length_partition``.  The next document is that of the next smaller doc_id (of one doc_id: the
    next text, nulls as empty texts), after the last the first; a row without doc_id comes after
    all others.  Two empty fingerprints are alike (1), an empty and another one are not (0).
    """
    spark = docs.sparkSession
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    table = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    table = table.withColumn("position", F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e300)))
    rows = _neighbours(table, "position", n_buckets).sortWithinPartitions("copy", F.desc("position"), F.desc("doc_id"), "text")
    fields = [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("length_partition", pa.int32())]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[str], list[str]]]:
        """Groups of own rows with the texts that follow them."""
        ids, texts, nexts, size, waiting, done = [], [], [], 0, None, False
        for batch in batches:
            for doc, text, copy in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "copy"))):
                if done:
                    continue
                if waiting is not None:
                    ids.append(waiting[0])
                    texts.append(waiting[1])
                    nexts.append(text)
                    size += len(waiting[1])
                done = copy  # further copies stand behind the first
                waiting = None if copy else (doc, text)
                if size > W.SLAB:
                    yield ids, texts, nexts
                    ids, texts, nexts, size = [], [], [], 0
        if ids:
            yield ids, texts, nexts

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, nexts in pairs(batches):
            cut = [len(t) // 3 for t in texts]
            edited = [t[: len(t) - k] + x[:k] for t, x, k in zip(texts, nexts, cut)]
            own = signatures([*texts, nexts[-1]])
            follow = [own[i + 1] for i in range(len(texts))]  # within a range the next text is the next row
            other = signatures(edited)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip([
                ids, [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                [as_text(s) for s in own[:-1]], [as_text(s) for s in other],
                [jaccard(a, b) for a, b in zip(own, other)], [jaccard(a, b) for a, b in zip(own, follow)],
                [length_partition(len(s), 0.8) for s in own[:-1]],
            ], fields)], [f for f, _ in fields])

    ddl = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, length_partition int")
    return rows.select("doc_id", "text", "copy").mapInArrow(make, ddl)


def _parts(fingerprint: Column) -> Column:
    return F.regexp_extract_all(fingerprint, F.lit("([0-9a-f]{8})"), 1)


def near_duplicates(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs ``a, b, similarity`` of different non-empty fingerprints at least ``threshold`` alike.

    ``prints`` has a column ``fingerprint``; equal ones are taken once, so copies never multiply.  Each set
    is put into its length partition and the one above it.  Within a partition, two sets meet if
    they share one of their rarest signatures (those before the last ``ceil(threshold * n) - 1``);
    lengths prune the meetings, and the rest is counted exactly.
    """
    sets = prints.filter("fingerprint <> ''").select("fingerprint").distinct()
    size = (F.length("fingerprint") / 8).cast("int")
    level = F.floor(F.log(size) / math.log(1 / threshold) + 1e-9).cast("int")
    sets = write_once(sets.select("fingerprint", size.alias("n"), level.alias("level")), "fingerprints")
    every = sets.select("fingerprint", "n", "level", F.explode(_parts(F.col("fingerprint"))).alias("signature"))
    often = every.groupBy("signature").count()
    ordered = (
        every.join(often, "signature").groupBy("fingerprint", "n", "level")
        .agg(F.sort_array(F.collect_list(F.struct("count", "signature"))).alias("ranked"))
        .select("fingerprint", "n", "level", F.expr(f"slice(ranked, 1, n - cast(ceil({threshold} * n - 1e-9) as int) + 1)").alias("rare"))
    )
    met = write_once(ordered.select("fingerprint", "n", "level", F.explode("rare.signature").alias("signature")), "rare_signatures")
    above = met.select(F.col("fingerprint").alias("b"), F.col("n").alias("m"), F.col("level").alias("top"), "signature")
    pairs = (
        met.select(F.col("fingerprint").alias("a"), "n", "level", "signature").join(above, "signature")
        .filter((F.col("top") - F.col("level")).isin(0, 1) & ((F.col("top") > F.col("level")) | (F.col("a") < F.col("b"))))
        .filter((F.col("n") >= threshold * F.col("m") - 1e-9) & (F.col("m") >= threshold * F.col("n") - 1e-9))
        .select("a", "b", "n", "m").distinct()
    )
    both = F.size(F.array_intersect(_parts(F.col("a")), _parts(F.col("b"))))
    return pairs.withColumn("similarity", both / (F.col("n") + F.col("m") - both)).filter(F.col("similarity") >= threshold - 1e-9).select("a", "b", "similarity")
