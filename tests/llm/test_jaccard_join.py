import random
import re

import numpy as np
import pytest

from opinara.llm import jaccard_join
from opinara.llm.components import components

from .conftest import ODD_TEXTS

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_force(rows):
    sets = [(doc, shingles(text)) for doc, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((doc, len(s), least[find(i)]) for i, (doc, s) in enumerate(sets))


def edited(words, rng, share):
    out = list(words)
    for _ in range(int(len(out) * share)):
        i = rng.randrange(len(out))
        out[i : i + 1] = rng.choice([[], ["new" + str(rng.randrange(999))], [out[i], "plus"]])
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    word = lambda: "w" + str(rng.randrange(400))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 30, 150, 300]))]
        for _ in range(rng.choice([1, 5, 25])):
            texts.append(" ".join(edited(base, rng, rng.choice([0, 0.005, 0.02, 0.04]))))
    for _ in range(80):  # one passage, much of it or little
        own = [word() for _ in range(rng.choice([5, 20, 60]))]
        texts.append(" ".join(own) + "\n" + passage)
    chain = [word() for _ in range(200)]
    for i in range(40):  # each similar to the next only
        texts.append(" ".join(chain[i * 3 :] + chain[: i * 3]).upper())
    texts += [texts[0], texts[0], "a b", "a b", "a b c"] + ODD_TEXTS
    rng.shuffle(texts)
    return [(1000 - 3 * i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("permutations,many", [(4, (8, 64)), (1, (2,)), (4, (0, 1, 3))])
def test_equals_brute_force(make_docs, rows, monkeypatch, permutations, many):
    monkeypatch.setattr(jaccard_join, "PERMUTATIONS", permutations)
    monkeypatch.setattr(jaccard_join, "MANY", many)
    got = jaccard_join.similar_groups(make_docs(rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_force(rows)


def test_a_large_group_is_not_paired_with_what_is_far_from_it(make_docs, monkeypatch):
    rng = random.Random(5)
    base = ["b" + str(i) for i in range(100)]
    texts = [" ".join(base[:i] + ["x" + str(i)] + base[i + 1 :]) for i in range(0, 100, 2)]
    texts += [" ".join(base[:45] + ["y" + str(rng.random()) for _ in range(60)]) for _ in range(40)]
    rows = list(enumerate(texts))
    monkeypatch.setattr(jaccard_join, "MANY", (1000,))  # all tokens alike: shared ones are in the prefixes
    asked, verified = [], jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, *rest: asked.append(pairs.count()) or verified(pairs, *rest))
    got = jaccard_join.similar_groups(make_docs(rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_force(rows)
    assert asked[-1] < 100


def test_folded_bits_keep_every_link(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows, similar = [], []
    for n in (1, 3, 20, 150, 900, 4000, 9000):
        for share in (0, 0.05, 0.1, 0.11, 0.3, 1):
            a, new = (np.unique(rng.integers(0, 2**64, k, np.uint64)) for k in (n, round(n * share)))
            b = np.unique(np.concatenate([a[len(new) :], new]))
            both = len(np.intersect1d(a, b))
            rows.append((len(rows), len(a), jaccard_join._parity(a).tolist(), len(b), jaccard_join._parity(b).tolist()))
            similar.append(100 * both >= 80 * (len(a) + len(b) - both))
    table = spark.createDataFrame(rows, "id int, n long, parity array<long>, n_b long, parity_b array<long>")
    table = table.select("*", *jaccard_join._folded("p")).drop("parity").withColumnRenamed("parity_b", "parity")
    table = table.select("*", *jaccard_join._folded("q"))
    kept = {r["id"] for r in table.filter(jaccard_join._may_link(80)).collect()}
    assert kept >= {i for i, s in enumerate(similar) if s} and len(kept) < len(rows)


def test_repeated_ids_and_empty_table(make_docs):
    assert jaccard_join.similar_groups(make_docs([])).count() == 0
    rows = [(7, "a b c d e f g h i j"), (7, "x y z"), (8, "x y z"), (9, "a b c d e f g h i j")]
    got = jaccard_join.similar_groups(make_docs(rows)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(7, 7), (7, 7), (8, 7), (9, 7)]


def test_components_of_chain_and_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["label"], set()).add(r["node"])
    assert sorted(map(len, groups.values())) == [201, 300]
