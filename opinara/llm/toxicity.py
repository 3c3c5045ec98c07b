"""Toxicity of texts after noisy-channel deobfuscation.

A written token is a noisy copy of a word: letters replaced by look-alikes, repeated,
parted by symbols or spaces.  The possible originals form a lattice of characters, and
Viterbi decoding under a character trigram model picks the likeliest.  The score is a
naive Bayes posterior over restored words and their beginnings, so that inflected forms
count together.

Tokens of letters without repetition have a single path and skip the decoder; workers
remember what they have decoded.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once
from . import words as W
from .wordcache import WordCache, bounded_sample

# Letters that a sign may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l",
}
SWAPPED, DROPPED, ONCE_OF_TWO, ONCE_OF_MANY, TWICE_OF_MANY = -0.5, -1.0, -2.5, -0.2, -1.0
SPELLED_OUT = 4  # so many single characters in a row are one word with gaps
MAX_TOKEN = 64  # longer tokens have no word in them and are kept as they are
SURE = 1.64  # standard errors by which a feature's log odds must be above zero
BEGINNINGS = (4, 5, 6)
PER_TOKEN = 2 * (1 + len(BEGINNINGS))
CODES = 64
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in LOOKS_LIKE)
_REPEATED = re.compile(r"(.)\1")


def code(ch: str) -> int:
    """Number of a character for the character model: 0 is the word's edge."""
    n = ord(ch)
    return n - 96 if 97 <= n <= 122 else 27 + n % (CODES - 27)


def character_model(counts: np.ndarray) -> np.ndarray:
    """log P(third | first two) from trigram counts, backed off to shorter contexts."""
    three = counts.astype(float)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + CODES)
    p2 = (two + 4 * p1) / (two.sum(axis=1, keepdims=True) + 4)
    return np.log((three + 4 * p2) / (three.sum(axis=2, keepdims=True) + 4))


def trigram_counts(words: list[str], times: np.ndarray) -> np.ndarray:
    """Counts of all character trigrams of lower-case words with their edges, each word so many ``times``."""
    points = W.code_points("".join("\0\0" + w for w in words) + "\0").astype(np.int64)
    codes = np.where((points >= 97) & (points <= 122), points - 96, 27 + points % (CODES - 27))
    codes[points == 0] = 0
    weight = np.repeat(times, [len(w) + 2 for w in words])  # a trigram is its word's that the middle letter is in, or begins
    last = np.arange(2, len(codes))
    last = last[(codes[last] > 0) | (codes[last - 1] > 0)]
    keys = (codes[last - 2] * CODES + codes[last - 1]) * CODES + codes[last]
    return np.bincount(keys, weight[last - 1], CODES**3).astype(np.int64)


def _paths(ch: str, n: int) -> list[tuple[str, float]]:
    """What ``n`` times ``ch`` may stand for, with the channel's log probability."""
    letters = [(ch, 0.0)] if ch.isalnum() else [("", DROPPED)]
    letters += [(x, SWAPPED) for x in LOOKS_LIKE.get(ch, "")]
    out = []
    for x, cost in letters:
        if n == 1 or not x:
            out.append((x, cost))
        elif n == 2:
            out += [(x + x, cost), (x, cost + ONCE_OF_TWO)]
        else:
            out += [(x, cost + ONCE_OF_MANY), (x + x, cost + TWICE_OF_MANY)]
    return out


def decode(token: str, model: list) -> str:
    """The likeliest original of a lower-case token; ``model[a][b][c]`` are log probabilities."""
    states = {(0, 0): (0.0, "")}
    for unit in re.finditer(r"(.)\1*", token, re.DOTALL):
        paths = [(x, cost, [code(c) for c in x]) for x, cost in _paths(unit[1], len(unit[0]))]
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (total, text) in states.items():
            for x, cost, codes in paths:
                score, p, q = total + cost, a, b
                for c in codes:
                    score += model[p][q][c]
                    p, q = q, c
                if (p, q) not in after or after[p, q][0] < score:
                    after[p, q] = score, text + x
        states = after
    return max((score + model[p][q][0], text) for (p, q), (score, text) in states.items())[1]


def restore(token: str, model: list) -> str:
    """A lower-case token without its noise; tokens without a letter stay."""
    core = token.strip(_EDGE)
    if core.isalpha() and not _REPEATED.search(core):
        return core
    if len(core) > MAX_TOKEN or not any(c.isalpha() for c in core):
        return core or token
    return decode(core, model)


def features(token: str, model: list) -> list[str]:
    """The restored word and its beginnings, and those of the token itself where it differs."""
    out = []
    for word in dict.fromkeys((restore(token, model), token.strip(_EDGE))):
        out += [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]
    return out


class Model(NamedTuple):
    characters: np.ndarray  # log P, CODES ** 3
    features: list[str]
    present: np.ndarray  # what a feature's presence adds to the log odds, beyond its absence
    base: float  # log odds of a text without any of the features
    key: str


class _Texts:
    """Tokens of a group of texts, those spelled out among them."""

    def __init__(self, texts: list[str]):
        self.texts = [t.lower() for t in texts]
        words = W.split(self.texts, lower=False)
        single = words.end - words.start == 1
        edge = np.ones(len(single) + 1, bool)
        edge[1:-1] = (single[1:] != single[:-1]) | (words.text[1:] != words.text[:-1])
        cuts = np.flatnonzero(edge)
        self.words, self.spelled = words, []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if single[a] and b - a >= SPELLED_OUT:
                text = self.texts[words.text[a]]
                self.spelled.append((int(words.text[a]), "".join(text[s] for s in words.start[a:b])))
        self.hashes, self.first, self.which = np.unique(words.hash, return_index=True, return_inverse=True)

    def token(self, place: int) -> str:
        i = self.first[place]
        return self.texts[self.words.text[i]][self.words.start[i] : self.words.end[i]]


def learn(docs: DataFrame, labels: DataFrame, rows: int = 10_000) -> Model:
    """Fit on at most ``rows`` labelled documents (whole texts) of each class, in a hashed order of doc_id.

    ``labels(doc_id, toxic)``: null labels and documents without one are left out.  A feature is
    used if at least five toxic texts have it, in five times the share that it has among the
    others, and its smoothed log odds are ``SURE`` standard errors above zero, whatever share of the
    toxic texts that is.  The sample bounds the number of features.  Equal texts count
    once.  Characters are counted in every word of all ``docs``.
    """
    spark = docs.sparkSession
    labels = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = bounded_sample(labels.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "toxic", rows)
    ids = write_once(ids, "labelled_ids")  # at most 2 * rows
    sample = write_once(docs.join(F.broadcast(ids), "doc_id").select("text", "toxic").dropDuplicates(["text"]), "labelled_texts")

    def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES**3, np.int64)
        for batch in batches:
            for _, texts in W.groups(batch.column("text").to_pylist()):
                some = _Texts(texts)
                times = np.bincount(some.which, minlength=len(some.hashes))
                cores = [some.token(i).strip(_EDGE) for i in range(len(some.hashes))]
                real = np.array([x.isalpha() for x in cores], bool)
                total += trigram_counts([x for x, ok in zip(cores, real) if ok], times[real])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at), "n": pa.array(total[at])})

    got = docs.select("text").mapInArrow(trigrams, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CODES**3, np.int64)
    counts[got["at"].to_numpy()] = got["n"].to_numpy()
    characters = character_model(counts.reshape(CODES, CODES, CODES))
    shared = spark.sparkContext.broadcast(characters)

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = shared.value.tolist(), {}
        for batch in batches:
            toxic = batch.column("toxic").to_pylist()
            for at, texts in W.groups(batch.column("text").to_pylist()):
                some = _Texts(texts)
                number: dict[str, int] = {}
                lists = []
                for i, h in enumerate(some.hashes.tolist()):
                    if h not in known:
                        known[h] = features(some.token(i), table)
                    lists.append([number.setdefault(f, len(number)) for f in known[h]])
                sizes = np.fromiter(map(len, lists), np.int64, len(lists))
                text_word = np.unique(some.words.text * (1 << 32) + some.which)
                word = text_word & 0xFFFFFFFF
                n = sizes[word]
                flat = np.fromiter((f for x in lists for f in x), np.int64, int(sizes.sum()))
                begin = np.cumsum(sizes) - sizes
                ends = np.cumsum(n)
                of = flat[np.repeat(begin[word] - (ends - n), n) + np.arange(int(n.sum()))]
                pairs = [np.repeat(text_word >> 32 << 32, n) + of]
                pairs += [
                    np.array([t << 32 | number.setdefault(f, len(number)) for f in features(x, table)]) for t, x in some.spelled]
                pairs = np.unique(np.concatenate(pairs))
                is_toxic = np.array(toxic[at : at + len(texts)])[pairs >> 32] == 1
                n1, n0 = (np.bincount((pairs & 0xFFFFFFFF)[x], minlength=len(number)) for x in (is_toxic, ~is_toxic))
                yield pa.RecordBatch.from_pydict({"word": pa.array(list(number), pa.string()), "n1": pa.array(n1), "n0": pa.array(n0)})

    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}  # two rows
    n1, n0 = n.get(1, 0), sum(n.values()) - n.get(1, 0)
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
    error = F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    words = (
        sample.mapInArrow(restored, "word string, n1 long, n0 long").groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        .filter((F.col("n1") >= 5) & (F.col("n1") * (n0 + 1) >= 5.0 * (F.col("n0") + 1) * n1) & (odds > SURE * error))
        .orderBy(F.desc("n1"), "word").collect()
    )
    p1 = np.array([(r["n1"] + 0.5) / (n1 + 1) for r in words])
    p0 = np.array([(r["n0"] + 0.5) / (n0 + 1) for r in words])
    absent = np.log(1 - p1) - np.log(1 - p0)
    base = math.log((n1 + 0.5) / (n0 + 0.5)) + float(absent.sum()) if n1 else -math.inf
    return Model(characters, [r["word"] for r in words], np.log(p1) - np.log(p0) - absent, base, uuid.uuid4().hex)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``score`` from 0 to 1.

    Null and empty texts have no words and the score of a text without toxic words; with
    no toxic text learnt from, every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.characters)
    named, many = docs.sparkSession.sparkContext.broadcast(model.features), max(1, len(model.features))
    present, base, key = model.present, model.base, model.key
    others = [c for c in docs.columns if c not in ("text", "score")]  # the new columns replace any of their names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cache = shared.value.tolist(), WordCache.of(key, PER_TOKEN, np.int32)
        numbers = {w: i for i, w in enumerate(named.value)}

        def found(token: str) -> list[int]:
            return [numbers[f] for f in features(token, table) if f in numbers]

        for batch in batches:
            for at, texts in W.groups(batch.column("text").to_pylist()):
                some = _Texts(texts)

                def make(new: np.ndarray) -> np.ndarray:
                    out = np.full((len(new), PER_TOKEN), -1, np.int32)
                    for row, i in zip(out, new.tolist()):
                        got = found(some.token(i))
                        row[: len(got)] = got
                    return out

                rows = cache.get(some.hashes, make)
                marked = (rows >= 0).any(axis=1)[some.which]
                of = rows[some.which[marked]].astype(np.int64)
                pairs = [(some.words.text[marked][:, None] * many + of)[of >= 0]]
                pairs += [np.array([text * many + i for i in found(token)], np.int64) for text, token in some.spelled]
                pairs = np.unique(np.concatenate(pairs)).astype(np.int64)
                odds = base + np.bincount(pairs // many, present[pairs % many], len(texts))
                share = 1 / (1 + np.exp(-np.clip(odds, -700, 700))) if base > -math.inf else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(at, len(texts)) for c in others), pa.array(share)], [*others, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others)
    return docs.mapInArrow(run, f"{kinds}, score double")
