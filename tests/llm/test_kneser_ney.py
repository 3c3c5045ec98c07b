import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import kneser_ney as K

from .conftest import ODD_TEXTS

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)), "</s>"]


def brute_force(rows, trains):
    count, pairs = collections.Counter(), collections.Counter()
    for doc, text in rows:
        if trains(doc):
            t = tokens(text)
            count.update(t)
            pairs.update(zip(["<s>", *t], t))
    n, v = sum(count.values()), len(count)
    of = collections.Counter(pairs.values())
    d2 = K.discounts(*(of[i] for i in (1, 2, 3, 4)))
    follows = collections.Counter(w for _, w in pairs)
    of = collections.Counter(follows.values())
    d1 = K.discounts(*(of[i] for i in (1, 2, 3, 4)))
    cut = lambda c, d: 0 if not c else d[min(c, 3) - 1]
    mass = sum(cut(c, d1) for c in follows.values())
    starts = collections.Counter()
    spare = collections.Counter()
    for (a, _), c in pairs.items():
        starts[a] += c
        spare[a] += cut(c, d2)

    def lower(w):
        return (follows[w] - cut(follows[w], d1) + mass / (v + 1)) / len(pairs)

    def p(a, w):
        return (pairs[a, w] - cut(pairs[a, w], d2) + spare[a] * lower(w)) / starts[a] if starts[a] else lower(w)

    out = {}
    for doc, text in rows:
        t = tokens(text)
        out[doc] = (len(t), sum(count[w] > 0 for w in t), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t),
                    sum(math.log10(p(a, w)) for a, w in zip(["<s>", *t], t)))
    contexts = [a for a in starts][:5]
    for a in contexts:  # a distribution over the known words and one unknown
        assert sum(p(a, w) for w in count) + p(a, "never seen") == pytest.approx(1)
    return out


@pytest.mark.parametrize("chunk", [200, 1_000_000])
def test_equals_brute_force(make_docs, monkeypatch, chunk):
    monkeypatch.setattr(K, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(K, "SHARD_KEYS", 3 * chunk)
    rng = random.Random(6)
    words = [f"W{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(150)] + ODD_TEXTS
    rows = list(enumerate(texts))
    got = K.perplexity_table(make_docs(texts), F.col("doc_id") % 5 != 2).collect()
    want = brute_force(rows, lambda d: d % 5 != 2)
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == pytest.approx(want[r["doc_id"]], rel=1e-9)


def test_pack_round_trip():
    for values in ([], [0], [0, 0, 0], [1, 2**63, 5], list(range(1000))):
        assert K.unpack(K.pack(np.array(values, np.uint64))).tolist() == values


def test_nothing_learnt_and_no_documents(make_docs):
    rows = K.perplexity_table(make_docs(["a b", None]), F.lit(False)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == [(3, 0, 0, 0, 0), (1, 0, 0, 0, 0)]
    assert K.perplexity_table(make_docs([]), F.lit(True)).count() == 0
