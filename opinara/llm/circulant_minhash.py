"""Near-duplicate classes by circulant MinHash, banding and exact verification.

Two permutations of the 32-bit numbers make the whole signature: the first scatters the
shingles, the second is applied after a circular shift by ``k`` for coordinate ``k``, so no
coordinate needs a permutation of its own.  ``BANDS`` bands of ``ROWS`` coordinates are
bucket keys; a pair at a similarity of 0.85 shares none with a probability of 3e-7.

Equal sets become one node.  Buckets are not opened into all pairs: round by round the members
of a bucket that are not connected to its largest class are compared with one member of it.
Buckets whose members are all connected are done.  What is still apart after
``PIVOT_ROUNDS`` is compared within its bucket, where the join itself applies two exact bounds
(sizes, and parity bits of the sets) before a pair comes out.  Every link is confirmed on the
full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from . import words as W
from .components import components
from .jaccard_join import shingle_sets

BANDS, ROWS = 26, 5
PIVOT_ROUNDS = 4
PARITY_BITS = 10  # 1024 bits in 16 longs


def permute(x: np.ndarray, multipliers: tuple[int, int], spare: np.ndarray | None = None) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place: odd multipliers and shifted exclusive-ors can be undone."""
    spare = np.empty_like(x) if spare is None else spare
    for shift, by in ((16, multipliers[0]), (15, multipliers[1]), (16, None)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if by:
            np.multiply(x, np.uint32(by), out=x)
    return x


FIRST, SECOND = (0x7FEB352D, 0x846CA68B), (0x9E3779B1, 0x85EBCA6B)


def signatures(sets: list[np.ndarray], n: int = BANDS * ROWS) -> np.ndarray:
    """``n`` coordinates of each set that is not empty: minima under the second permutation, shifted by 0 to n - 1."""
    sets = [s for s in sets if len(s)]
    out = np.empty((len(sets), n), np.uint32)
    if not sets:
        return out
    starts = np.cumsum([0, *map(len, sets[:-1])])
    scattered = permute((np.concatenate(sets) >> np.uint64(32)).astype(np.uint32), FIRST)
    moved, spare = np.empty_like(scattered), np.empty_like(scattered)
    for k in range(n):
        np.add(scattered, np.uint32(k), out=moved)
        out[:, k] = np.minimum.reduceat(permute(moved, SECOND, spare), starts)
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key per band; keys of different bands differ."""
    bands = signature.reshape(len(signature), signature.shape[1] // rows, rows)
    keys = np.broadcast_to(W.mix(np.arange(1, bands.shape[1] + 1)), bands.shape[:2]).copy()
    for r in range(rows):
        keys = W.mix(keys * np.uint64(W.BASE) + bands[:, :, r])
    return keys.view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _parity(shingles: np.ndarray) -> np.ndarray:
    odd = np.bincount((shingles >> np.uint64(64 - PARITY_BITS)).astype(np.int64), minlength=1 << PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n`` and, of sets that are not empty, ``node`` (a digest of the set), band keys and parity bits."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in W.groups(batch.column("text").to_pylist()):
                sets = shingle_sets(texts, size)
                keys = iter(band_keys(signatures(sets)))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(at, len(texts)), "n": pa.array(map(len, sets), pa.int64()),
                    "node": pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    "bands": pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    "parity": pa.array([_parity(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                })

    return docs.mapInArrow(make, "doc_id long, n long, node binary, bands array<long>, parity array<long>")


def _fits(a: str, b: str, percent: int) -> Column:
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def _may_link(percent: int) -> Column:
    """Whether the sets can differ so little: parity bits differ in at most as many places as the sets do."""
    words = range((1 << PARITY_BITS) // 64)
    differ = sum((F.bit_count(F.col("parity_a")[i].bitwiseXOR(F.col("parity_b")[i])) for i in words), F.lit(0))
    total = F.col("n_a") + F.col("n_b")
    least_common = F.expr(f"({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent}")
    return _fits("n_a", "n_b", percent) & (differ <= total - 2 * least_common)


def confirm(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``pairs`` of nodes ``a, b`` whose full sets are similar enough."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("parity").alias(f"parity_{x}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").filter(_may_link(percent)).select("a", "b")
    pairs = write_once(pairs, "minhash_pairs")
    wanted = nodes.join(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "node").select("node", F.col("first_doc").alias("doc"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in W.groups(batch.column("text").to_pylist()):
                node, sets = batch.column("node").slice(at, len(texts)).to_pylist(), shingle_sets(texts, size)
                own = [len(s) > 0 and _digest(s) == d for s, d in zip(sets, node)]  # else another row of that doc_id
                yield pa.RecordBatch.from_pydict({
                    "node": pa.array([d for d, o in zip(node, own) if o], pa.binary()),
                    "shingles": pa.array([s.tobytes() for s, o in zip(sets, own) if o], pa.binary())})

    sets = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("doc"))).select("node", "text").mapInArrow(
        sets_of, "node binary, shingles binary").dropDuplicates(["node"])
    sets = write_once(sets, "minhash_sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, ok = batch.column("left"), batch.column("right"), np.zeros(len(batch), bool)
            for i in range(len(batch)):
                a, b = (np.frombuffer(x[i].as_buffer(), np.uint64) for x in (left, right))
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                ok[i] = 100 * both >= percent * (len(a) + len(b) - both)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents link when ``100 * |A & B| >= percent * |A | B|`` on their sets of ``size``-word
    shingles (fewer words: the whole sequence); ``component_id`` is the smallest doc_id
    reachable by links, ``kept`` marks the row of that id.  Texts without words (null, empty)
    have no shingles and stay alone.  Rows of one doc_id count as several documents; a null
    doc_id is never the smallest unless there is no other.  Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    table = write_once(sketches(docs, size), "minhash_sketches")
    nodes = write_once(
        table.filter("n > 0").groupBy("node").agg(
            F.min("doc_id").alias("first_doc"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"),
            F.any_value("parity").alias("parity")), "minhash_nodes")
    members = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    members = write_once(members.join(write_once(shared, "minhash_keys").select("key"), "key"), "minhash_buckets")
    links = groups = tried = None

    def compare(pairs: DataFrame) -> None:
        """Confirm pairs not compared before; the classes that all links make."""
        nonlocal links, groups, tried
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = write_once(pairs, "minhash_candidates")
        tried = pairs if tried is None else tried.union(pairs)
        found = write_once(confirm(pairs, docs, nodes, size, percent), "minhash_links")
        links = found if links is None else links.union(found)
        groups = components(links)

    def grouped(rows: DataFrame) -> DataFrame:
        if groups is None:
            return rows.withColumn("group", F.col("node"))
        found = groups.select("node", F.col("label").alias("group"))
        return rows.join(found, "node", "left").withColumn("group", F.coalesce("group", "node"))

    for turn in range(PIVOT_ROUNDS + 1):
        rows = write_once(grouped(members), "minhash_members")
        order = F.xxhash64("node", F.lit(turn))
        classes = rows.groupBy("key", "group").agg(
            F.count("*").alias("members"), F.min(F.struct(order.alias("h"), "node", "n")).alias("one"))
        buckets = classes.groupBy("key").agg(
            F.max(F.struct("members", "group", "one")).alias("most"), F.sum("members").alias("in_all"), F.count("*").alias("classes"))
        # two nodes that were compared and found apart are done
        buckets = write_once(buckets.filter((F.col("classes") > 1) & (F.col("in_all") > (2 if turn else 1))), "minhash_open")
        if buckets.isEmpty():
            break
        if turn < PIVOT_ROUNDS:
            pivots = buckets.select("key", F.col("most.group").alias("other"), F.col("most.one.node").alias("b"), F.col("most.one.n").alias("n_b"))
            apart = rows.join(pivots, "key").filter(F.col("group") != F.col("other"))
            members = write_once(rows.drop("group").join(buckets.select("key"), "key"), "minhash_buckets")
            compare(apart.filter(_fits("n", "n_b", percent)).select(F.col("node").alias("a"), "b"))
        else:
            rows = rows.join(buckets.select("key"), "key").join(nodes.select("node", "parity"), "node")
            side = lambda x: rows.select("key", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "group", "parity")))  # noqa: B023, E731
            apart = (F.col("group_a") < F.col("group_b")) & _may_link(percent)
            compare(side("a").join(side("b"), "key").filter(apart).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))

    first = grouped(nodes.select("node", "first_doc"))
    least = first.groupBy("group").agg(F.min("first_doc").alias("component_id"))
    by_node = first.join(least, "group").select("node", "component_id")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return table.select("doc_id", "n", "node").join(by_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))
