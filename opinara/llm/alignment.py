"""Alignment of the tokens of two tokenizers by the bytes they cover.

A text with a space before it is coded by a byte-level BPE file (A) and by a sentencepiece
model (B).  The tokenizer's character offsets and the spans of sentencepiece's proto cut the
text; where a character is split over tokens, or a span is empty (byte fallback, the added
space), the decoded bytes of the tokens place the cut.  Places where tokens of both end cut
the tokens into groups, and all A-B pairs within a group are links.

Neither tokenizer merges anything across a single space between two characters that are no
white space, so a text is coded in units that begin with such a space, each distinct unit
of some documents once; a worker remembers up to ``KNOWN_UNITS``.  Documents are handled in
chunks of about ``CHUNK`` characters: a chunk keeps a dictionary of its units and of the
pairs in them, its documents refer to units by number, and what the corpus knows of a pair
comes back to a chunk once, not once for every document.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from . import tokens
from . import words as W

CHUNK = 4 << 20
KNOWN_UNITS = 1_000_000
TOGETHER = 1 << 17  # characters of units that are coded in one call
LARGE_GROUP = 1 << 16  # links of a group beyond which its tokens are counted before they are paired
#: Anything that either tokenizer might treat as a space, and more: beside these no cut is made.
_SPACES = [*range(0x21), *range(0x7F, 0xA1), 0xAD, 0x1680, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2030),
           *range(0x205F, 0x2070), 0x2581, 0x3000, 0xFEFF]
_SPACE_LIKE = np.zeros(0x10000, bool)
_SPACE_LIKE[_SPACES] = True
_ODD = frozenset(map(chr, _SPACES))

ALIGNED = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, units array<int>, "
    "times array<int>, pairs array<long>, docs array<int>, unit_sizes array<int>, unit_pairs array<int>, unit_times array<int>")
COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def token_ends(starts: np.ndarray, stops: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte place past each token: the end of its span, or by its decoded size where spans say nothing.

    Spans (in bytes) that are empty, or that overlap the next one because a character is
    split, tell only where the whole character lies.
    """
    alone = starts < stops
    alone[:-1] &= starts[1:] >= stops[:-1]
    decoded = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(alone, np.arange(len(alone)), -1))
    since = np.where(last >= 0, stops[last] - decoded[last], 0)
    return np.where(alone, stops, since + decoded)


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of runs one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class Tokens:
    """Ragged rows of tokens, each coded as ``2 * id``, plus 1 for the last of its group."""

    def __init__(self, sizes: np.ndarray, codes: np.ndarray):
        self.sizes, self.codes = sizes.astype(np.int64), codes.astype(np.int32)

    def rows(self, which: np.ndarray) -> Tokens:
        start = np.cumsum(self.sizes) - self.sizes
        return Tokens(self.sizes[which], self.codes[_spread(start[which], self.sizes[which])])

    def and_rows(self, other: Tokens) -> Tokens:
        return Tokens(np.append(self.sizes, other.sizes), np.append(self.codes, other.codes))


NOTHING = Tokens(np.empty(0), np.empty(0))


class Aligner:
    """Both tokenizers, and the units met last; one for each worker and pair of files."""

    _loaded: dict[tuple[str, str], Aligner] = {}

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        bytes_of = {letter: value for value, letter in enumerate(tokens._BYTES)}
        entries = (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size()))
        self.a_bytes = [bytes(bytes_of[c] for c in t) if all(c in bytes_of for c in t) else t.encode() for t in entries]
        pieces = ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        # by code: the id and what follows it in the text of groups
        self.a_said = np.array([f"{i}{end}".encode() for i in range(len(self.a_bytes)) for end in ",|"], object)
        self.b_said = np.array([f"{i}{end}".encode() for i in range(len(self.b_bytes)) for end in ",;"], object)
        self.forget()

    def forget(self) -> None:
        self.hashes, self.row, self.used = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.known, self.turn = (NOTHING, NOTHING), 0

    @classmethod
    def load(cls, a_path: str, b_path: str) -> Aligner:
        if (a_path, b_path) not in cls._loaded:
            cls._loaded[a_path, b_path] = cls(a_path, b_path)
        return cls._loaded[a_path, b_path]

    def text_tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and byte ends of a text behind the added space, of A and of B; None where token bytes differ from it."""
        whole, spaced = (" " + text).encode(), " " + text
        coded = self.a.encode(spaced, add_special_tokens=False)
        pieces = list(self.b.encode(text, return_type="proto").pieces)
        a, spans = coded.ids, coded.offsets
        b = [p.id for p in pieces]
        if b"".join([self.a_bytes[t] for t in a]) != whole or b"".join([self.b_bytes[t] for t in b]) != whole:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_spans = np.fromiter(chain.from_iterable(spans), np.int64, 2 * len(a)).reshape(-1, 2)
        b_spans = np.fromiter(((p.begin + 1, p.end + 1) for p in pieces), np.dtype((np.int64, 2)), len(b))
        if len(whole) != len(spaced):
            points = W.code_points(spaced)
            byte_at = np.append(0, np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)))
            a_spans = byte_at[a_spans]
            if b_spans[-1, 1] <= len(spaced):  # the library gives spans in bytes, older versions in characters
                b_spans = byte_at[b_spans]
        return (a, token_ends(a_spans[:, 0], a_spans[:, 1], self.a_sizes[a]),
                b, token_ends(b_spans[:, 0], b_spans[:, 1], self.b_sizes[b]))

    def align(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        """Tokens of units that the added space precedes; none where joined token bytes differ from space and text.

        Units that neither begin nor end with anything like a space are coded together,
        because nothing is merged over the single spaces between them.
        """
        plain = [i for i, t in enumerate(texts) if t and t[0] not in _ODD and t[-1] not in _ODD and "▁" not in t]
        others = sorted(set(range(len(texts))) - set(plain))
        sizes = np.cumsum([len(texts[i]) for i in plain]) // TOGETHER
        work = [list(map(plain.__getitem__, x)) for x in np.split(np.arange(len(plain)), np.flatnonzero(np.diff(sizes)) + 1)]
        work = [x for x in work if x] + [[i] for i in others]
        out_a, out_b, order = [NOTHING], [NOTHING], []
        while work:
            rows = work.pop()
            found = self.text_tokens(" ".join(texts[i] for i in rows))
            if found is None and len(rows) > 1:
                work += [[i] for i in rows]
                continue
            ends = np.cumsum([len(texts[i].encode()) + 1 for i in rows])
            order += rows
            if found is None:
                a, a_ends, b, b_ends = (np.empty(0, np.int64),) * 4
            else:
                a, a_ends, b, b_ends = found
            both = np.intersect1d(a_ends, b_ends, assume_unique=True)
            last_a, last_b = (np.isin(x, both, assume_unique=True, kind="sort") for x in (a_ends, b_ends))
            sizes = lambda x: np.diff(np.searchsorted(x, ends, "right"), prepend=0)
            out_a.append(Tokens(sizes(a_ends), 2 * a + last_a))
            out_b.append(Tokens(sizes(b_ends), 2 * b + last_b))
        back = np.argsort(np.array(order, np.int64))
        return tuple(Tokens(*(np.concatenate(y) for y in zip(*((t.sizes, t.codes) for t in x)))).rows(back) for x in (out_a, out_b))

    def units(self, hashes: np.ndarray, text_of: Callable[[int], str]) -> tuple[Tokens, Tokens]:
        """Tokens of distinct, ascending hashes; ``text_of`` gives the texts of those not known yet, by place."""
        self.turn += 1
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        new = np.flatnonzero(~known)
        self.used[at[known]] = self.turn
        if len(new):
            found = self.align([text_of(i) for i in new.tolist()])
            rows = len(self.known[0].sizes) + np.arange(len(new))
            self.known = tuple(x.and_rows(y) for x, y in zip(self.known, found))
            order = np.argsort(np.append(self.hashes, hashes[new]), kind="stable")
            self.hashes = np.append(self.hashes, hashes[new])[order]
            self.row = np.append(self.row, rows)[order]
            self.used = np.append(self.used, np.full(len(new), self.turn))[order]
        rows = self.row[np.searchsorted(self.hashes, hashes)]
        out = tuple(x.rows(rows) for x in self.known)
        if len(self.hashes) > KNOWN_UNITS:  # those used last stay
            keep = self.used >= np.partition(self.used, len(self.used) - KNOWN_UNITS // 2)[len(self.used) - KNOWN_UNITS // 2]
            keep &= self.used > self.turn - 50
            if keep.sum() > KNOWN_UNITS:
                self.forget()
            else:
                self.known = tuple(x.rows(self.row[keep]) for x in self.known)
                self.hashes, self.used, self.row = self.hashes[keep], self.used[keep], np.arange(keep.sum())
        return out


def _split(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, str]:
    """Units of texts with a space before each: text's place, first and past-last character, hash, and the joined texts."""
    joined = "".join(" " + t for t in texts)
    points = W.code_points(joined)
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    odd = np.ones(len(points) + 2, bool)
    odd[1:-1] = (points < 0x10000) & _SPACE_LIKE[np.minimum(points, 0xFFFF)]
    opens = np.zeros(len(points) + 1, bool)
    opens[:-1] = (points == 0x20) & ~odd[:-2] & ~odd[2:]
    opens[first] = True
    edges = np.flatnonzero(opens)
    start, end = edges[:-1], edges[1:]
    return np.searchsorted(first, start, "right") - 1, start, end, W.run_hashes(points, start, end), joined


_TYPES = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def _rows(columns: dict, n: int) -> pa.RecordBatch:
    fields = [f.split() for f in ALIGNED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], _TYPES[t]) if c in columns else pa.nulls(n, _TYPES[t]) for c, t in fields], [c for c, _ in fields])


def unit_links(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``unit, pair, links``: the distinct pairs of each unit (A id in the upper half) with their number of links."""
    group_a, group_b = (np.cumsum(x.codes & 1) - (x.codes & 1) for x in (a, b))
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    n_a, n_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    unit = np.empty(n, np.int64)
    unit[group_a] = np.repeat(np.arange(len(a.sizes)), a.sizes)
    begin_b = np.cumsum(n_b) - n_b
    large = np.flatnonzero(n_a * n_b > LARGE_GROUP)
    each = np.where(n_a * n_b > LARGE_GROUP, 0, n_b)[group_a]
    left = np.repeat(a.codes.astype(np.int64) >> 1, each)
    right = b.codes[_spread(begin_b[group_a], each)].astype(np.int64) >> 1
    units, pairs, links = [np.repeat(unit[group_a], each)], [left << 32 | right], [np.ones(len(left), np.int64)]
    for g in large.tolist():
        (x, n_x), (y, n_y) = (np.unique(t.codes[of == g].astype(np.int64) >> 1, return_counts=True) for t, of in ((a, group_a), (b, group_b)))
        pairs.append((x[:, None] << 32 | y).ravel())
        links.append((n_x[:, None] * n_y).ravel())
        units.append(np.full(len(pairs[-1]), unit[g]))
    unit, pair, link = (np.concatenate(x) for x in (units, pairs, links))
    distinct, number = np.unique(pair, return_inverse=True)
    key, at = np.unique(unit * max(1, len(distinct)) + number, return_inverse=True)
    sums = np.bincount(at, weights=link, minlength=len(key)).astype(np.int64)
    return key // max(1, len(distinct)), distinct[key % max(1, len(distinct))], sums


def group_texts(a: Tokens, b: Tokens, a_said: np.ndarray, b_said: np.ndarray) -> list[bytes]:
    """The groups of each unit as text, ``a1,a2|b1;a3|b2,b3``."""
    last_a, last_b = a.codes & 1, b.codes & 1
    b_before = np.append(0, np.flatnonzero(last_b) + 1)[np.cumsum(last_a) - last_a]
    a_before = (np.flatnonzero(last_a) + 1)[np.cumsum(last_b) - last_b]
    said = np.empty(len(a.codes) + len(b.codes), object)
    said[np.arange(len(a.codes)) + b_before] = a_said[a.codes]
    said[np.arange(len(b.codes)) + a_before] = b_said[b.codes]
    items, stops = said.tolist(), np.cumsum(a.sizes + b.sizes).tolist()
    return [b"".join(items[i:j])[:-1] for i, j in zip([0, *stops[:-1]], stops)]


def _documents(aligner: Aligner, chunk: int, ids: pa.Array, texts: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of the documents of a chunk, and the row of its dictionary."""
    doc, start, end, hashes, joined = _split(texts)
    some, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    a, b = aligner.units(some, lambda i: joined[start[first[i]] + 1 : end[first[i]]])
    del joined, hashes
    # a text has tokens if all its units have
    has = np.array([bool(t) for t in texts], bool)
    has[doc[(a.sizes == 0)[which]]] = False
    doc, which = doc[has[doc]], which[has[doc]]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))

    unit, pair, links = unit_links(a, b)
    sizes = np.bincount(unit, minlength=len(some))
    in_groups = np.append(0, np.cumsum(a.codes & 1))
    unit_ends = np.cumsum(a.sizes)
    figures = {
        "n_a": a.sizes, "n_b": b.sizes, "n_groups": in_groups[unit_ends] - in_groups[unit_ends - a.sizes],
        "n_links": np.bincount(unit, weights=links, minlength=len(some)).astype(np.int64)}

    def total(each: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(each[which]))
        return sums[bounds[1:]] - sums[bounds[:-1]]

    parts, order = group_texts(a, b, aligner.a_said, aligner.b_said), which.tolist()
    digests = [
        hashlib.sha256(b";".join([parts[u] for u in order[i:j]])).hexdigest() if j > i else ""
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    del parts, order

    n_units = max(1, len(some))
    held, times = np.unique(doc * n_units + which, return_counts=True)
    held_doc, held_unit = held // n_units, held % n_units
    cuts = np.searchsorted(held_doc, np.arange(len(texts) + 1))

    # documents per pair: pairs of the distinct units of each document, each pair once a document
    distinct, number = np.unique(pair, return_inverse=True)
    begins, n = np.cumsum(sizes) - sizes, sizes[held_unit]
    key = np.repeat(held_doc * max(1, len(distinct)), n) + number[_spread(begins[held_unit], n)]
    if len(texts) * len(distinct) < 1 << 32:
        key = key.astype(np.uint32)
    in_docs = np.bincount((np.unique(key) % max(1, len(distinct))).astype(np.int64), minlength=len(distinct))

    lists = lambda x: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x.astype(np.int32)))
    yield _rows({
        "chunk": np.full(len(texts), chunk), "doc_id": ids, "groups_sha256": digests,
        "units": lists(held_unit), "times": lists(times), **{c: total(x) for c, x in figures.items()},
    }, len(texts))
    yield _rows({c: [x] for c, x in {
        "chunk": chunk, "pairs": distinct, "docs": in_docs.astype(np.int32), "unit_sizes": sizes.astype(np.int32),
        "unit_pairs": number.astype(np.int32), "unit_times": links.astype(np.int32)}.items()}, 1)


def aligned_chunks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row per document, and per chunk one with its dictionary (``pairs`` not null)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, chunk = Aligner.load(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, texts in W.groups(batch.column("text").to_pylist(), CHUNK):
                yield from _documents(aligner, chunk, batch.column("doc_id").slice(at, len(texts)), texts)
                chunk += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(make, ALIGNED)


def _counted(rows: pa.Table, known: pa.Table) -> pa.Table:
    """Documents of one chunk with the corpus-wide figures of its pairs."""
    book = rows.filter(pc.is_valid(rows["pairs"]))
    rows = rows.filter(pc.is_null(rows["pairs"]))
    arrays = {c: book[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("unit_sizes", "unit_pairs", "unit_times")}
    n_pairs = len(book["pairs"].combine_chunks().flatten())
    docs, best = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
    docs[known["nth"].to_numpy()] = known["docs"].to_numpy()
    best[known["nth"].to_numpy()] = known["best"].to_numpy()
    stops = np.cumsum(arrays["unit_sizes"], dtype=np.int64)

    def per_document(of_pair: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(of_pair[arrays["unit_pairs"]] * arrays["unit_times"]))
        of_unit = sums[stops] - sums[stops - arrays["unit_sizes"]]
        units, times = rows["units"].combine_chunks(), rows["times"].combine_chunks()
        sums = np.append(0, np.cumsum(of_unit[units.flatten().to_numpy()] * times.flatten().to_numpy()))
        ends = np.append(0, np.cumsum(pc.list_value_length(units).to_numpy(zero_copy_only=False)))
        return sums[ends[1:]] - sums[ends[:-1]]

    columns = {c: rows[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    columns |= {"n_best": pa.array(per_document(best)), "count_sum": pa.array(per_document(docs))}
    return pa.table(columns | {"groups_sha256": rows["groups_sha256"]})


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per row of ``docs``: tokens of both tokenizers, groups, links, and how its links stand in the corpus.

    ``n_best`` counts the links whose pair is held by as many documents as any pair of its A
    id, ``count_sum`` adds up how many documents hold each link's pair.  Texts that are null
    or empty, or that a tokenizer does not give back byte by byte, have no tokens: zeros and
    an empty ``groups_sha256``.  Rows of one doc_id count as several documents; other columns
    of ``docs`` are not read.
    """
    a_path, b_path = a_path or tokens.path("byte_bpe_50k.json"), b_path or tokens.path("piece_bpe_32k.model")
    rows = write_once(aligned_chunks(docs, a_path, b_path), "aligned")
    held = rows.filter("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("nth", "held"))
    counts = write_once(held.groupBy(F.col("held.pairs").alias("pair")).agg(F.sum("held.docs").alias("docs")), "pair_counts")
    of_a = F.shiftright("pair", 32).cast("int").alias("a")
    most = counts.groupBy(of_a).agg(F.max("docs").alias("most"))  # a row per A id: the vocabulary bounds it
    counts = counts.withColumn("a", of_a).join(F.broadcast(most), "a").select(
        "pair", "docs", (F.col("docs") == F.col("most")).cast("int").alias("best"))
    back = held.select(F.col("chunk").alias("of_chunk"), "nth", F.col("held.pairs").alias("pair")).join(counts, "pair")
    back = back.select("of_chunk", "nth", "docs", "best")
    return rows.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(_counted, COUNTED)
