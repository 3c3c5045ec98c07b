"""Language identification with segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.  A word's
probability is the sum over all ways to cut it into pieces, found by the forward
algorithm; a text's is the product over its words.  Piece probabilities come from
expectation maximisation over a bounded sample of labelled texts.

The forward algorithm runs on distinct words, all words of a length at once, and workers
remember words they have scored.
"""

from __future__ import annotations

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
from .tokens import _BYTES, PieceTokenizer
from .wordcache import WordCache, bounded_sample

END = 0x110000  # the word end, beyond all code points
MAX_WORD = 40  # longer words are scored in parts
SLOTS = 18
WORDS_AT_ONCE = 50_000  # new words that a worker scores together
LETTERS = np.ones(129, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), 128]] = False
_MAY_HAVE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Signs like a superscript two are word characters of regular expressions, but no letters."""
    found = _MAY_HAVE_LETTER.search(text)
    return found is not None and (found[0].isalpha() or any(c.isalpha() for c in text))


class Pieces:
    """Numbers of pieces by hash: tables by the top bits, a further one for what collides."""

    def __init__(self, names: list[str]):
        self.names = names
        self.longest = max((len(n.removesuffix("</w>")) + n.endswith("</w>") for n in names), default=1)
        points = [np.array([*map(ord, n.removesuffix("</w>")), *[END] * n.endswith("</w>")], np.uint32) for n in names]
        hashes = np.concatenate([W.run_hashes(p, np.array([0]), np.array([len(p)])) for p in points])
        self.hashes = np.append(hashes, np.uint64(0))
        self._fill()

    def _fill(self) -> None:
        self.tables = []
        left = np.arange(len(self.names))
        while len(left):
            slots = (self.hashes[left] >> np.uint64(64 - SLOTS - len(self.tables))).astype(np.int64)
            _, first = np.unique(slots, return_index=True)
            table = np.full(1 << (SLOTS + len(self.tables)), -1, np.int32)
            table[slots[first]] = left[first]
            self.tables.append(table)
            left = np.delete(left, first)

    def __getstate__(self) -> tuple:
        return self.names, self.longest, self.hashes  # the tables are many times larger and soon filled again

    def __setstate__(self, state: tuple) -> None:
        self.names, self.longest, self.hashes = state
        self._fill()

    @classmethod
    def of_vocabulary(cls, path: str) -> Pieces:
        """All pieces of whole characters, however long, in a byte-level vocabulary with word ends.

        A piece that ends inside a character spells no run of code points of any word.
        """
        from tokenizers import Tokenizer

        byte = {c: b for b, c in enumerate(_BYTES)}
        names = set()
        for shown in Tokenizer.from_file(path).get_vocab(with_added_tokens=False):
            core, end = shown.removesuffix("</w>"), shown.endswith("</w>")
            try:
                core = bytes(byte[c] for c in core).decode()
            except (UnicodeDecodeError, KeyError):
                continue
            if core or end:
                names.add(core + "</w>" * end)
        return cls(sorted(names))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers, the number of pieces where there is none."""
        out = np.full(len(hashes), len(self.names), np.int32)
        for i, table in enumerate(self.tables):
            got = table[hashes >> np.uint64(64 - SLOTS - i)]
            hit = (got >= 0) & (self.hashes[got] == hashes)
            out[hit] = got[hit]
        return out


class Model(NamedTuple):
    languages: list[str]
    probability: np.ndarray  # pieces + 1 by languages; the last row is for no piece
    unknown: np.ndarray  # of a single code point, by language
    key: str


def _by_length(words: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = np.array(list(map(len, words)))
    for n in np.unique(sizes).tolist():
        some = np.flatnonzero(sizes == n)
        for at in range(0, len(some), 20_000):
            part = some[at : at + 20_000]
            yield part, np.stack([words[i] for i in part])


def _spans(points: np.ndarray, pieces: Pieces) -> Iterator[tuple[int, int, np.ndarray]]:
    """Start, end and piece number of every span of same-length words that is no longer than the longest piece."""
    n = points.shape[1]
    up, _ = W.powers(n + 1)
    value = points.astype(np.uint64) + np.uint64(1)
    for end in range(1, n + 1):
        total = np.zeros(len(points), np.uint64)
        # a span one code point longer at its front: the sum so far moves up by one power
        for start in range(end - 1, max(0, end - pieces.longest) - 1, -1):
            total = value[:, start] + total * up[1]
            yield start, end, pieces.find(W.mix(total))


def forward(points: np.ndarray, pieces: Pieces, probability: np.ndarray, unknown: np.ndarray) -> np.ndarray:
    """``alpha[word, place, language]``: probability of all segmentations up to each place."""
    n = points.shape[1]
    alpha = np.zeros((len(points), n + 1, probability.shape[1]))
    alpha[:, 0] = 1
    for start, end, piece in _spans(points, pieces):
        p = probability[piece]
        if end - start == 1:
            p = p + unknown
        alpha[:, end] += alpha[:, start] * p
    return alpha


def expected(points: np.ndarray, weight: np.ndarray, pieces: Pieces, probability: np.ndarray, unknown: np.ndarray) -> np.ndarray:
    """Expected uses of each piece by language, over all segmentations; ``weight[word, language]`` counts words."""
    alpha = forward(points, pieces, probability, unknown)
    spans = list(_spans(points, pieces))
    beta = np.zeros_like(alpha)
    beta[:, -1] = 1
    for start, end, piece in reversed(spans):
        beta[:, start] += beta[:, end] * (probability[piece] + unknown * (end - start == 1))
    share = weight / np.maximum(alpha[:, -1], 1e-300)
    out = np.zeros_like(probability)
    for start, end, piece in spans:
        got = alpha[:, start] * probability[piece] * beta[:, end] * share
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(piece, got[:, k], len(out))
    return out


def word_points(text: str, start: int, end: int) -> np.ndarray:
    return np.append(W.code_points(text[start:end]), np.uint32(END))


def learn(docs: DataFrame, vocabulary: str, rows: int = 500, rounds: int = 2) -> Model:
    """Fit on at most ``rows`` documents (whole texts) for each language of ``docs(doc_id, lang, text)``.

    The sample is taken in a hashed order of doc_id.  Probabilities begin as counts of all
    occurrences of a piece, and ``rounds`` of expectation maximisation follow; every step is
    a Spark job whose result has at most one row per piece and language.
    """
    pieces = Pieces.of_vocabulary(vocabulary)
    spark = docs.sparkSession
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = bounded_sample(labelled.select("doc_id", "lang"), "lang", rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, texts in W.groups(batch.column("text").to_pylist()):
                lowered = [t.lower() for t in texts]
                words = W.split(lowered, LETTERS)
                _, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
                for lang in set(langs[at : at + len(texts)]):
                    mine = np.array([x == lang for x in langs[at : at + len(texts)]])[words.text]
                    n = np.bincount(which[mine], minlength=len(first))
                    got = np.flatnonzero(n)
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(got), pa.string()),
                        "word": pa.array([lowered[words.text[i]][words.start[i] : words.end[i]] for i in first[got]], pa.string()),
                        "n": pa.array(n[got], pa.int64()),
                    })

    sample = labelled.join(F.broadcast(ids.select("doc_id", F.col("lang").alias("of"))), "doc_id").filter(F.col("of") == F.col("lang"))
    counts = write_once(
        sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language_words")
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    shared = spark.sparkContext.broadcast(pieces)
    probability, unknown = np.ones((len(pieces.names) + 1, len(languages))), np.full(len(languages), 1e-9)

    def uses(first: bool, probability: np.ndarray, unknown: np.ndarray):
        current = spark.sparkContext.broadcast(probability)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(current.value)
            for batch in batches:
                words, owner = [], []  # long words in parts, as they are scored
                for nth, word in enumerate(batch.column("word").to_pylist()):
                    for s in range(0, len(word), MAX_WORD):
                        words.append(word_points(word, s, min(s + MAX_WORD, len(word))))
                        owner.append(nth)
                if not words:
                    continue
                weight = np.zeros((len(words), len(languages)))
                lang = np.array([languages.index(x) for x in batch.column("lang").to_pylist()])
                weight[np.arange(len(words)), lang[owner]] = batch.column("n").to_numpy()[owner]
                for part, points in _by_length(words):
                    if first:
                        for _, _, piece in _spans(points, shared.value):
                            for k in range(total.shape[1]):
                                total[:, k] += np.bincount(piece, weight[part, k], len(total))
                    else:
                        total += expected(points, weight[part], shared.value, current.value, unknown)
            at, lang = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({"piece": pa.array(at), "k": pa.array(lang), "uses": pa.array(total[at, lang])})

        return run

    for turn in range(rounds + 1):
        got = (
            counts.mapInArrow(uses(turn == 0, probability, unknown), "piece long, k long, uses double")
            .groupBy("piece", "k").agg(F.sum("uses").alias("uses")).toArrow()
        )
        total = np.full_like(probability, 0.01)
        total[got["piece"].to_numpy(), got["k"].to_numpy()] += got["uses"].to_numpy()
        total[-1] = 0
        probability = total / np.maximum(total.sum(axis=0), 1)
        unknown = 0.1 * np.min(probability[:-1], axis=0) if languages else unknown
    return Model(languages, probability, unknown, uuid.uuid4().hex)


def predict(docs: DataFrame, model: Model, vocabulary: str, evidence: int = 40, keep_text: bool = False) -> DataFrame:
    """The columns of ``docs``, ``text`` among them with ``keep_text`` only, and ``lang_pred`` and ``score``.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learnt.  The
    score is the posterior of the language with even priors, where a text counts as at
    most ``evidence`` independent words; one word moves two languages apart by at most a
    factor of e**8.  Ties go to the language first by name.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((Pieces.of_vocabulary(vocabulary), model.probability))
    languages, unknown, key = model.languages, model.unknown, model.key
    others = [c for c in docs.columns if c not in ("lang_pred", "score") and (keep_text or c != "text")]  # the new columns replace any of their names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        PieceTokenizer.forget()  # of a step before, whose worker this was
        pieces, probability = shared.value
        cache = WordCache.of(key, len(languages))
        for batch in batches:
            for at, texts in W.column_groups(batch.column("text")):
                lowered = [t.lower() for t in texts]
                words = W.split(lowered, LETTERS)
                hashes, first, which = np.unique(words.hash, return_index=True, return_inverse=True)

                def score(new: np.ndarray) -> np.ndarray:
                    out = np.zeros((len(new), len(languages)))
                    for begin in range(0, len(new), WORDS_AT_ONCE):
                        parts, owner = [], []
                        for nth, i in enumerate(first[new[begin : begin + WORDS_AT_ONCE]].tolist(), begin):
                            text = lowered[words.text[i]]
                            for s in range(words.start[i], words.end[i], MAX_WORD):
                                parts.append(word_points(text, s, min(s + MAX_WORD, words.end[i])))
                                owner.append(nth)
                        for part, points in _by_length(parts):
                            got = np.log(np.maximum(forward(points, pieces, probability, unknown)[:, -1], 1e-300))
                            np.add.at(out, np.array(owner)[part], got)
                    return np.maximum(out, out.max(axis=1, keepdims=True) - 8) if len(languages) else out

                known = cache.get(hashes, score)
                n = np.bincount(words.text, minlength=len(texts))
                total = np.stack(
                    [np.bincount(words.text, known[which, k], len(texts)) for k in range(len(languages))] or [np.zeros(len(texts))], axis=1)
                total *= np.minimum(1, evidence / np.maximum(n, 1))[:, None]
                share = np.exp(total - total.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                best = share.argmax(axis=1)
                ok = [bool(languages) and has_letter(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(at, len(texts)) for c in others),
                     pa.array([languages[b] if o else "und" for b, o in zip(best, ok)], pa.string()),
                     pa.array([float(s[b]) if o else 0.0 for s, b, o in zip(share, best, ok)], pa.float64())],
                    [*others, "lang_pred", "score"])
            del batch  # before the next one is read

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in others)
    return docs.mapInArrow(run, f"{kinds}, lang_pred string, score double")
