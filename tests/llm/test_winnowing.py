import random
import re

import numpy as np
import pytest

from opinara.llm import winnowing
from opinara.llm import words as W

from .conftest import ODD_TEXTS

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute_force(doc, items, span=13):
    d, hit, found = words(doc), set(), set()
    for key, text in items:
        w = words(text)
        n = min(span, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(d) - n + 1):
            if n and tuple(d[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(str(key))
    return len(d), len(hit), sorted(found)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(3)
    some = ["ab", "cd", "Éf", "g7", "x"]
    items = [(i, " ".join(rng.choice(some) for _ in range(rng.choice([1, 3, 9, 12, 13, 20, 40])))) for i in range(12)]
    items += [(50, ""), (51, None), (52, items[0][1]), (53, "one two"), (54, "q " * 30)]
    docs = []
    for _ in range(60):
        text = " ".join(rng.choice(some + ["zz", "yy"]) for _ in range(rng.randint(0, 50)))
        for _ in range(rng.randint(0, 2)):
            item = words(rng.choice(items)[1])
            a, b = sorted((rng.randint(0, len(item)), rng.randint(0, len(item))))
            text += ", " + " ".join(item[a:b]).upper() + "; tail"
        docs.append(text)
    return docs + [docs[0], "Q " * 40, "one, two", "one three two"] + ODD_TEXTS, items


def test_equals_brute_force(spark, make_docs, cases):
    docs, items = cases
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = winnowing.contamination(make_docs(docs), table).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_hit"], r["item_ids"]) for r in rows] == [brute_force(d, items) for d in docs]
    assert sum(r["n_hit"] > 0 for r in rows) > 10


def test_long_spans_share_a_fingerprint():
    rng = np.random.default_rng(1)
    span = W.mix(rng.integers(0, 4, 13).astype(np.uint64))
    for _ in range(50):
        a, b = (np.concatenate([W.mix(rng.integers(0, 4, n).astype(np.uint64)), span]) for n in rng.integers(0, 20, 2))
        keys = [set(winnowing.fingerprints(x, np.zeros(len(x)), 8, 6)[1].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = winnowing.contamination(make_docs(["a b"]), none).collect()
    assert [(r["n_words"], r["n_hit"], r["item_ids"]) for r in rows] == [(2, 0, [])]
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert winnowing.contamination(make_docs([]), one).count() == 0
