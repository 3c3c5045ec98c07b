"""Exact self-join on n-gram Jaccard similarity with a token-group matrix.

Similar documents are put into groups first, and the matrix says which tokens (shingles)
any member of a group holds; a document is compared with the members of a group only if
the matrix row leaves room for enough overlap.

1. Equal sets become one node.
2. Nodes with an equal minimum under one of ``PERMUTATIONS`` hash functions are compared with
   one of them, then, while some are apart, with others of the largest group among them, up to
   ``PIVOT_ROUNDS`` times; connected nodes form a group.  The work is linear in the nodes.
3. The matrix is kept for the tokens that can decide: a set of n shingles with a partner
   shares one of its first ``n - ceil(0.8 n) + 1`` tokens with it, in any order that is the
   same for all sets, and the smaller of the two shares one of a still shorter prefix.  The order puts tokens of more documents later (in steps, ``MANY``) and
   skips tokens of a single one.  A node and a *different*, not smaller group that share such a token and whose
   sizes fit are a qualifying pair: ``WITNESSES`` times one member of the group is compared
   and groups that turn out to be linked are joined; then, for pairs still apart, every
   member is that shares a token and whose parity bits leave room for the overlap.  The bits
   are part of that join's condition, so a large group makes no rows of pairs that are far apart.

Tokens of one and of many documents are known from counts over all documents, handed to
the workers as bit sets of at most 2**28 bits; a wrong bit only changes the common order or
keeps a token needlessly, never the result.  Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, write_once
from . import words as W
from .components import components

PERMUTATIONS = 4
MANY = (8, 64, 512, 4096)
PIVOT_ROUNDS = 5
WITNESSES = 2
PARITY_BITS = 11
FOLDED_WORDS = 16  # of 64 parity bits, which the last join carries
MAX_BITS = 28
COUNTED = 0.35  # share of a set's tokens, lowest hashes first, that is counted


def shingle_sets(texts: list[str], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    words = W.split(texts)
    bounds = W.offsets(words, len(texts))
    grams = W.grams(words.hash, size)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(W.grams(words.hash[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _node(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _each(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at, texts in W.groups(batch.column("text").to_pylist()):
            yield batch.slice(at, len(texts)), shingle_sets(texts, size)


def _parity(shingles: np.ndarray) -> np.ndarray:
    """For each value of a token's top bits, whether an odd number of tokens has it."""
    odd = np.bincount((shingles >> np.uint64(64 - PARITY_BITS)).astype(np.int64), minlength=1 << PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _folded(name: str) -> list[Column]:
    """The parity bits of a row on ``FOLDED_WORDS`` columns ``name0, name1, ...``; bits that meet are added without carry."""
    words = range((1 << PARITY_BITS) // 64)
    own = [[F.col("parity")[k] for k in words[i::FOLDED_WORDS]] for i in range(FOLDED_WORDS)]
    return [reduce(lambda x, y: x.bitwiseXOR(y), w).alias(f"{name}{i}") for i, w in enumerate(own)]


def _may_link(percent: int) -> Column:
    """Whether sets of ``n, n_b`` tokens can differ so little: folded parity bits differ in at most as many places as the sets do.

    A quarter of the bits tells most pairs apart.
    """
    differ = lambda words: sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"q{i}"))) for i in range(words)), F.lit(0))
    least_common = F.expr(f"({percent} * (n + n_b) + {99 + percent}) div {100 + percent}")
    room = F.col("n") + F.col("n_b") - 2 * least_common
    return (differ(FOLDED_WORDS // 4) <= room) & (differ(FOLDED_WORDS) <= room)


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _first_size(n: int, percent: int) -> int:
    """Prefix of the smaller (or equal) set of a pair."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def _counted(n: int, percent: int) -> int:
    return max(_prefix_size(n, percent), int(COUNTED * n)) if n else 0


def sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, n, node``, the minima of the set under each hash function, its parity bits, and its lowest tokens.

    ``low`` holds the tokens of the lowest hashes, in their order: somewhat more than the prefix of most sets.
    """
    salts = W.mix(np.arange(1, PERMUTATIONS + 1).astype(np.uint64))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _each(batches, size):
            least = [[int(W.mix(s ^ salt).min().view(np.int64)) for salt in salts] if len(s) else [] for s in sets]
            low = [s[: _counted(len(s), percent)].view(np.int64) for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": pa.array(map(len, sets), pa.int64()),
                "node": pa.array(map(_node, sets), pa.int64()), "least": pa.array(least, pa.list_(pa.int64())),
                "parity": _lists([_parity(s) if len(s) else s.view(np.int64) for s in sets]), "low": _lists(low),
            })

    return docs.mapInArrow(make, "doc_id long, n long, node long, least array<long>, parity array<long>, low array<long>")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


def whole_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, n, low`` of the nodes ``wanted(node)`` with all their tokens as ``low``, from a text of each."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _each(batches, size):
            own = [(node, s.view(np.int64)) for node, s in zip(batch.column("node").to_pylist(), sets) if _node(s) == node]
            yield pa.RecordBatch.from_pydict({  # other texts of a repeated doc_id drop out
                "node": pa.array([x for x, _ in own], pa.int64()), "n": pa.array([len(s) for _, s in own], pa.int64()),
                "low": _lists([s for _, s in own]),
            })

    at = nodes.select("node", F.col("first_doc").alias("doc")).join(wanted, "node")
    texts = docs.join(at, F.col("doc_id").eqNullSafe(F.col("doc"))).select("node", "text")
    return texts.mapInArrow(make, "node long, n long, low array<long>")


def _prefixes(batch: pa.RecordBatch, many: list[tuple[int, np.ndarray]], percent: int):
    """The tokens of a batch of ``n, low``, and per set its row, first place, n, and the places of its prefix.

    Tokens held by more sets come later, else lower hashes first.  ``None``: the prefix may
    hold tokens beyond ``low``.
    """
    lists = batch.column("low")
    tokens, bounds = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
    level = sum(holds(filled, tokens).astype(np.int8) for filled in many)
    found = []
    for row, (a, b, n) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), batch.column("n").to_pylist())):
        size = _prefix_size(n, percent)
        places = np.flatnonzero(level[a:b] == 0)[:size]
        if len(places) < size:
            places = np.argsort(level[a:b], kind="stable")[:size] if b - a == n else None
        found.append((row, a, n, None if places is None else places + a))
    return tokens, bounds, found


def deep_nodes(lows: DataFrame, percent: int, many) -> DataFrame:
    """``node`` of the sets whose prefix may hold tokens beyond ``low``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deep = [row for row, _, _, places in _prefixes(batch, many.value, percent)[2] if places is None]
            yield batch.select(["node"]).take(pa.array(deep, pa.int64()))

    return lows.select("node", "n", "low").mapInArrow(make, "node long")


def late_tokens(sets: DataFrame, percent: int, many, whole: bool) -> DataFrame:
    """Of whole sets whose prefix goes beyond their counted tokens: the tokens beyond in it, or all of theirs (``whole``)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, bounds, found = _prefixes(batch, many.value, percent)
            late = [np.empty(0, np.uint64)]
            for row, a, n, places in found:
                counted = a + _counted(n, percent)
                beyond = places[places >= counted]
                if len(beyond):
                    late.append(tokens[counted : bounds[row + 1]] if whole else tokens[beyond])
            yield pa.RecordBatch.from_pydict({"token": pa.array(np.concatenate(late).view(np.int64))})

    return sets.select("n", "low").mapInArrow(make, "token long")


def bit_set(tokens: DataFrame, n: int, max_bits: int = MAX_BITS) -> tuple[int, np.ndarray]:
    """Bits in use and a set of the top bits of ``n`` tokens, 16 bits a token up to ``2**max_bits``."""
    bits = min(max_bits, max(16, (16 * n).bit_length()))
    place = tokens.select(F.shiftrightunsigned("token", 64 - bits).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit")
    rows = place.select(F.shiftright("place", 6).alias("word"), bit).groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["word"].to_numpy()] = rows["bit"].to_numpy().view(np.uint64)
    return bits, out


def holds(filled: tuple[int, np.ndarray], tokens: np.ndarray) -> np.ndarray:
    place = tokens >> np.uint64(64 - filled[0])
    return (filled[1][place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def postings(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """``token, node, n, first``: the prefix tokens that another set may hold too.

    ``first`` marks those in the shorter prefix that is enough for the smaller set of a pair.
    Most prefixes lie within ``low``; texts are split again only for the sets of the others.
    """
    spread = docs.sparkSession.sparkContext.broadcast

    def levels(counts: DataFrame):
        some = [counts.filter(F.col("count") > n) for n in MANY]
        return spread([bit_set(x, x.count()) for x in some])

    def deep_sets(many) -> DataFrame:
        deep = write_once(deep_nodes(nodes, percent, many), "deep_nodes")
        return write_once(whole_sets(docs, nodes, deep, size), "deep_sets")

    low = write_once(nodes.select(F.explode("low").alias("token")).groupBy("token").count().filter("count > 1"), "token_counts")
    many = levels(low)
    deep = deep_sets(many)
    late = late_tokens(deep, percent, many, whole=True).groupBy("token").count().filter("count > 1")
    counts = write_once(low.union(late).groupBy("token").agg(F.sum("count").alias("count")), "token_counts")
    discard(low, deep)
    many = levels(counts)
    deep = deep_sets(many)
    beyond = write_once(late_tokens(deep, percent, many, whole=False).distinct(), "late_tokens")
    several = spread(bit_set(counts.select("token").union(beyond), counts.count() + beyond.count()))
    discard(counts, beyond)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, _, found = _prefixes(batch, many.value, percent)
            found = [(row, n, places) for row, _, n, places in found if places is not None]
            if not found:
                continue
            places = np.concatenate([x for _, _, x in found])
            keep = holds(several.value, tokens[places])
            sizes = [len(x) for _, _, x in found]
            first = np.concatenate([np.arange(len(x)) < _first_size(n, percent) for _, n, x in found])
            rows = np.repeat(np.array([row for row, _, _ in found]), sizes)[keep]
            yield pa.RecordBatch.from_pydict({
                "token": pa.array(tokens[places[keep]].view(np.int64)), "node": batch.column("node").take(pa.array(rows)),
                "n": batch.column("n").take(pa.array(rows)), "first": pa.array(first[keep]),
            })

    sets = nodes.select("node", "n", "low").union(deep.select("node", "n", "low"))
    return sets.mapInArrow(make, "token long, node long, n long, first boolean")


def near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose parity bits allow the similarity: bits differ in at most as many places as the sets do."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            a, b = (batch.column(c).flatten().to_numpy().reshape(len(batch), -1) for c in ("p_a", "p_b"))
            differ = np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=1, dtype=np.int64)
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            both = -(-percent * total // (100 + percent))  # least intersection of sets of these sizes
            keep = pa.array(differ <= total - 2 * both)
            yield batch.select(["a", "b"]).filter(keep)

    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("parity").alias(f"p_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(compare, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of nodes whose sets are similar enough, from their whole texts, as a written table."""
    pairs = write_once(near(pairs, nodes, percent), "near_pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = write_once(
        docs.join(nodes.join(wanted, "node").select("node", F.col("first_doc").alias("doc")), F.col("doc_id").eqNullSafe(F.col("doc")))
        .select("node", "text").dropDuplicates(["node", "text"]), "texts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            left, right = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
            ok = np.zeros(len(a), bool)
            known: tuple[str | None, np.ndarray | None] = (None, None)
            for i in range(len(a)):
                one = shingle_sets([left[i]], size)[0]
                if known[0] != right[i]:
                    known = (right[i], shingle_sets([right[i]], size)[0])
                other = known[1]
                if _node(one) == a[i] and _node(other) == b[i]:  # rows of a repeated doc_id drop out
                    both = len(np.intersect1d(one, other, assume_unique=True))
                    ok[i] = 100 * both >= percent * (len(one) + len(other) - both)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a[ok]), "b": pa.array(b[ok])})

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    links = write_once(both.mapInArrow(compare, "a long, b long"), "links")
    discard(pairs, texts)
    return links


def similar_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Two documents link when ``100 * |A & B| >= percent * |A | B|``; ``component_id`` is the
    smallest doc_id reachable by links.  Texts without words (null, empty) have no shingles
    and stay alone.  Rows of one doc_id count as several documents.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sketched = write_once(sketches(docs, size, percent), "sketches")
    same = [F.first(c).alias(c) for c in ("n", "least", "parity", "low")]
    nodes = write_once(sketched.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_doc"), *same), "nodes")
    table = write_once(sketched.select("doc_id", "n", "node"), "sets")
    discard(sketched)
    sizes = nodes.select("node", "n")
    fits = lambda x, y: (100 * F.col(x) >= percent * F.col(y)) & (100 * F.col(y) >= percent * F.col(x))

    minima = write_once(nodes.select("node", "n", F.posexplode("least").alias("permutation", "value")), "minima")
    every = minima
    minima = write_once(every.join(
        every.groupBy("permutation", "value").count().filter("count > 1").drop("count"), ["permutation", "value"]), "minima")
    discard(every)
    links = groups = tried = None

    def grouped(rows: DataFrame) -> DataFrame:
        if groups is None:
            return rows.withColumn("group", F.col("node"))
        found = groups.select("node", F.col("label").alias("group"))
        return rows.join(found, "node", "left").withColumn("group", F.coalesce("group", "node"))

    def compare(pairs: DataFrame) -> bool:
        """Join the groups that pairs not compared before turn out to link; whether there were any."""
        nonlocal links, groups, tried
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = write_once(pairs, "pairs")
        if pairs.isEmpty():
            return False
        tried = pairs if tried is None else tried.union(pairs)
        found = verified(pairs, docs, nodes, size, percent)
        links = found if links is None else links.union(found)
        groups = components(links)
        return True

    for turn in range(PIVOT_ROUNDS):
        rows = grouped(minima)
        per_group = rows.groupBy("permutation", "value", "group").agg(
            F.count("*").alias("members"),
            F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("node"), F.col("n").alias("n"))).alias("w"))
        largest = per_group.groupBy("permutation", "value").agg(
            F.max(F.struct("members", "group", "w")).alias("x"), F.count("*").alias("groups")
        ).filter("groups > 1").select(
            "permutation", "value", F.col("x.group").alias("other"), F.col("x.w.node").alias("b"), F.col("x.w.n").alias("n_b"))
        apart = rows.join(largest, ["permutation", "value"]).filter((F.col("group") != F.col("other")) & fits("n", "n_b"))
        if not compare(apart.select(F.col("node").alias("a"), "b")):
            break

    shared = lambda posts, by: (
        posts.groupBy("token").agg(F.min(by).alias("low"), F.max(by).alias("high")).filter("low <> high").select("token"))
    held = write_once(postings(docs, nodes, size, percent), "postings")
    posts = write_once(held.join(shared(held, "node"), "token").distinct(), "postings")
    discard(held)
    for turn in range(WITNESSES + 1):
        every = write_once(grouped(posts), "matrix_rows")
        rows = write_once(every.join(shared(every, "group"), "token"), "matrix_rows")
        discard(every)
        matrix = rows.groupBy("token", "group").agg(
            F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.min(F.when(F.col("first"), F.col("n"))).alias("first_low"),
            F.count("*").alias("members"),
            F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("node"), F.col("n").alias("n"))).alias("w"))
        query = rows.join(matrix.select("token", "group", "members"), ["token", "group"])
        other = matrix.select("token", F.col("group").alias("other"), "n_low", "n_high", "first_low", F.col("members").alias("others"), "w")
        # the group with fewer members asks the other; its documents and the other's sizes must fit
        sizes_fit = (100 * F.col("n_high") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("n_low"))
        asks = (F.struct("members", "group") < F.struct("others", "other")) & sizes_fit
        smaller_first = F.col("first_low") <= F.col("n")
        qualifying = query.filter("first").join(other, "token").filter(asks & (smaller_first | (F.col("n_high") >= F.col("n")))).union(
            query.filter("NOT first").join(other.filter("first_low IS NOT NULL"), "token").filter(asks & smaller_first))
        if turn < WITNESSES:
            pairs = (
                qualifying.filter((100 * F.col("w.n") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("w.n")))
                .groupBy(F.col("node").alias("a"), "other").agg(F.min(F.struct("w.h", "w.node")).alias("w"))
                .select("a", F.col("w.node").alias("b"))
            )
        else:
            asked = write_once(qualifying.select("token", F.col("node").alias("a"), "n", "first", "other", "others", "first_low", "w"), "asked")
            shares = (F.col("first") & (F.col("n") <= F.col("n_b"))) | (F.col("first_b") & (F.col("n_b") <= F.col("n")))
            likely = fits("n", "n_b") & shares
            # the only member that has the token is known; several are met in a join
            one = asked.filter("others = 1").select(
                "a", "n", "first", F.col("w.node").alias("b"), F.col("w.n").alias("n_b"), F.col("first_low").isNotNull().alias("first_b"))
            many = asked.filter("others > 1").select("token", "a", "n", "first", "other")
            met = many.select("token", "other").distinct()
            members = rows.select(
                "token", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("group").alias("other"), F.col("first").alias("first_b")
            ).join(met, ["token", "other"], "left_semi").join(nodes.select(F.col("node").alias("b"), *_folded("q")), "b")
            many = many.join(nodes.select(F.col("node").alias("a"), *_folded("p")), "a")
            pairs = one.filter(likely).select("a", "b").union(
                many.join(members, ["token", "other"]).filter(likely & _may_link(percent)).select("a", "b"))
        compare(pairs)
        discard(rows)

    firsts = grouped(nodes.select("node", "first_doc"))
    least = firsts.groupBy("group").agg(F.min("first_doc").alias("component_id"))
    by_node = firsts.join(least, "group").select("node", "component_id")
    return table.select("doc_id", F.col("n").alias("n_shingles"), "node").join(by_node, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
