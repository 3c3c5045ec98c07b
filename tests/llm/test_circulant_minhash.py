import random
import re

import numpy as np
import pytest

from opinara.llm import circulant_minhash
from opinara.llm.jaccard_join import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = [w.translate({i: i + 32 for i in range(65, 91)}) for w in WORD.findall(text or "")]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_force(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=str)


def classes(df, **options):
    rows = circulant_minhash.near_duplicates(df, **options).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows), key=str)


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in words)


def test_equals_brute_force(spark):
    """Groups of copies at every distance, so links chain and many pairs lie just under the threshold."""
    rng = random.Random(5)
    rows = []
    for group in range(6):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([8, 60, 150]))]
        rows += [(len(rows) + i, edited(rng, words, rng.choice([0, 0.01, 0.02, 0.05, 0.1]))) for i in range(25)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert classes(df) == brute_force(rows, 3, 85)
    assert classes(df, size=5, percent=80) != []


def test_last_round_alone(spark, monkeypatch):
    """Without pivots the bounded join within buckets finds every link."""
    monkeypatch.setattr(circulant_minhash, "PIVOT_ROUNDS", 0)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(100)]
    rows = [(i, edited(rng, words, 0.03)) for i in range(50)]
    assert classes(spark.createDataFrame(rows, "doc_id long, text string")) == brute_force(rows, 3, 85)


def test_odd_rows(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    rows += [(3, "again the same id"), (3, "another text of it"), (None, "again the same id"), (None, None), (50, "A  b\tC"), (51, "b a")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = df.selectExpr("doc_id", "text", "1 AS node", "2 AS n", "3 AS component_id", "4 AS key", "5 AS kept")
    got = classes(clash)
    want = brute_force(rows, 3, 85)
    fix = lambda x: [r for r in x if r[0] is not None]
    assert fix(got) == fix(want) and len(got) == len(want)


def test_empty_table(make_docs):
    assert classes(make_docs(["a"]).limit(0)) == []
    assert classes(make_docs([None, ""])) == [(0, 0, 0, True), (1, 0, 1, True)]


def test_permutation_is_one():
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65_537)
    for by in (circulant_minhash.FIRST, circulant_minhash.SECOND):
        assert len(np.unique(circulant_minhash.permute(x.copy(), by))) == len(x)


@pytest.mark.parametrize("shared", [0.5, 0.85])
def test_coordinates_agree_as_often_as_sets_are_alike(shared):
    rng = np.random.default_rng(1)
    union = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    n = int(len(union) * shared)
    rest = len(union) - n
    a, b = np.unique(union[: n + rest // 2]), np.unique(np.concatenate([union[:n], union[n + rest // 2 :]]))
    one, other = circulant_minhash.signatures([a, b], 1024)
    assert abs((one == other).mean() - shared) < 0.06


def test_signature_of_each_set_is_its_own():
    sets = shingle_sets(["a b c d e", "", "x y z", "a b c d e"], 3)
    out = circulant_minhash.signatures(sets)
    assert out.shape == (3, circulant_minhash.BANDS * circulant_minhash.ROWS)
    assert (out[0] == out[2]).all() and (out[0] != out[1]).any()
    keys = circulant_minhash.band_keys(out)
    assert len(np.unique(keys[0])) == circulant_minhash.BANDS
