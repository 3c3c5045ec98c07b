import math
import re
from collections import Counter

import numpy as np
import pytest

from opinara.llm import lexical_search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [w.translate({i: i + 32 for i in range(65, 91)}) for w in WORD.findall(text or "")]


def brute_force(docs, items, k):
    words = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in words)
    n_terms = sum(sum(c.values()) for _, c in words)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    rows = []
    for item, some in wanted.items():
        scores = []
        for i, c in words:
            n, score = sum(c.values()), 0
            for t in some & set(c):
                df = sum(t in other for _, other in words)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                scores.append((-score, i is None, i))
        rows += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(rows, key=str)


def search(docs, items, k=10):
    return sorted((tuple(r) for r in lexical_search.ranked(docs, items, k).collect()), key=str)


def test_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(12).cache()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert search(docs, items) == brute_force(rows, [(r["item_id"], r["text"]) for r in items.collect()], 10)


def test_ties_repeats_nulls_and_odd_texts(spark, odd_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    docs += [(100 + i, "same text here") for i in range(40)] + [(7, "same text here"), (None, "same text here"), (None, None)]
    items = [("a", "Same text, HERE"), ("a", "word"), ("b", None), ("c", ""), (None, "日本語 here"), ("d", "nowhere_known?"), ("e", "e é È")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    clash = df.selectExpr("doc_id", "text", "1 AS item_id", "2 AS score", "3 AS term", "4 AS rank")
    queries = spark.createDataFrame(items, "item_id string, text string").selectExpr("item_id", "text", "1 AS doc_id", "2 AS n")
    assert search(clash, queries, 5) == brute_force(docs, items, 5)


def test_many_blocks_and_narrow_tiles(spark, make_docs, monkeypatch):
    """Items in several blocks, item tiles cut by their cells, several term tiles per product."""
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(lexical_search, "TILE_CELLS", 40)
    monkeypatch.setattr(lexical_search, "TERM_TILE", 3)
    monkeypatch.setattr(lexical_search, "DOC_TILE", 4)
    texts = [" ".join(f"w{(i * j) % 23}" for j in range(1, i % 9 + 2)) for i in range(60)]
    items = [(i, " ".join(f"w{(i + j) % 25}" for j in range(6))) for i in range(30)]
    got = search(make_docs(texts), spark.createDataFrame(items, "item_id long, text string"), 4)
    assert got == brute_force(list(enumerate(texts)), items, 4)


def test_empty_tables(spark, make_docs):
    items = spark.createDataFrame([("a", "x")], "item_id string, text string")
    assert lexical_search.ranked(make_docs(["x"]).limit(0), items).count() == 0
    assert lexical_search.ranked(make_docs([None, ""]), items).count() == 0
    assert lexical_search.ranked(make_docs(["x"]), items.limit(0)).count() == 0


def test_top_k_keeps_ties_by_document():
    rng = np.random.default_rng(3)
    top, every = lexical_search.TopK(3, 4), []
    for _ in range(20):
        scores, doc = rng.integers(0, 4, (4, 6)), rng.integers(0, 50, 6)
        top.add(0, scores, doc, np.zeros(6, bool))
        every += [(i, -scores[i, j], doc[j]) for i in range(4) for j in range(6) if scores[i, j] > 0]
    want = [row for i in range(4) for row in sorted(r for r in every if r[0] == i)[:3]]
    assert list(zip(top.item, -top.score, top.doc)) == want


@pytest.mark.parametrize("n", [0, 5, 10**12])
def test_weights_bound_partial_sums(n):
    weights = lexical_search.term_weights(n, np.array([0, min(n, 3), n]))
    assert weights.max() * lexical_search.IMPACT * lexical_search.TERM_TILE < 2**53
    big = lexical_search.impacts(np.array([1, 10**9]), np.array([10**9, 10**9]), 10**12, 10**15)
    assert (big < lexical_search.IMPACT).all() and (big >= 0).all()
