import itertools
import random

import numpy as np
import pytest

from opinara.llm import toxicity as T

from .conftest import ODD_TEXTS


@pytest.fixture(scope="module")
def model():
    words = ["stupid", "idiot", "moron", "apple", "letter", "tree", "good", "loser", "street", "little", "and", "the"]
    counts = np.zeros((T.CODES,) * 3)
    for w in words:
        c = [0, 0, *map(T.code, w), 0]
        for a, b, d in zip(c, c[1:], c[2:]):
            counts[a, b, d] += 5
    return T.character_model(counts)


def every_path(token, model):
    """Best original by trying all paths through the lattice."""
    units = [T._paths(k, len(list(g))) for k, g in itertools.groupby(token)]
    best = None
    for path in itertools.product(*units):
        text = "".join(x for x, _ in path)
        c = [0, 0, *map(T.code, text), 0]
        total = sum(cost for _, cost in path) + sum(model[a][b][d] for a, b, d in zip(c, c[1:], c[2:]))
        best = max(best or (total, text), (total, text))
    return best


def test_viterbi_equals_all_paths(model):
    rng = random.Random(4)
    table = model.tolist()
    for _ in range(200):
        token = "".join(rng.choice("1d0t.@$e3lloos5") * rng.choice([1, 1, 2, 3]) for _ in range(rng.randint(1, 7)))
        total, text = every_path(token, table)
        got = T.decode(token, table)
        c = [0, 0, *map(T.code, got), 0]
        assert text == got or total == pytest.approx(every_path(token, table)[0]), (token, text, got, c)


@pytest.mark.parametrize("token,want", [
    ("1d10t", "idiot"), ("st.u.p.i.d", "stupid"), ("m0r0n!", "moron"), ("l0000ser", "loser"), ("$tup1d", "stupid"),
    ("apple", "apple"), ("tree,", "tree"), ("trash###", "trash"), ("2024", "2024"), ("***", "***"),
])
def test_restore(model, token, want):
    assert T.restore(token, model.tolist()) == want


def test_model_sums_to_one(model):
    assert np.exp(model).sum(axis=2) == pytest.approx(1)


@pytest.fixture(scope="module")
def learnt(spark, make_docs):
    rng = random.Random(9)
    plain = [f"word{chr(97 + i)}" for i in range(20)]
    texts, labels = [], []
    for i in range(300):
        words = [rng.choice(plain) for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randrange(30), rng.choice(["idiot", "moron", "vequ" + rng.choice(["ais", "on", "er", "ente"])]))
        texts.append(" ".join(words))
        labels.append((i, int(toxic)))
    docs = make_docs(texts)
    return T.learn(docs, spark.createDataFrame([*labels, (5000, 1), (1, None)], "doc_id long, toxic int"))


def test_noisy_words_score_like_plain_ones(learnt, make_docs):
    plain = " worda wordb wordc wordd"
    texts = ["idiot" + plain, "1d10t" + plain, "i d i o t" + plain, "M0R0N!!" + plain, "Vequonne" + plain, plain, "stupendous" + plain]
    rows = sorted(T.score(make_docs(texts).select("doc_id", "text"), learnt).collect())
    scores = [r["score"] for r in rows]
    assert min(scores[:5]) > 0.5 and max(scores[5:]) < 0.1


def test_odd_rows(learnt, make_docs, spark):
    rows = {r["doc_id"]: r for r in T.score(make_docs(ODD_TEXTS).select("doc_id", "lang", "text"), learnt).collect()}
    assert len(rows) == len(ODD_TEXTS) and all(0 <= r["score"] < 0.3 for r in rows.values())
    assert rows[0]["score"] == rows[1]["score"] == rows[2]["score"]
    none = T.learn(make_docs([]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["score"] for r in T.score(make_docs(["a"]).select("doc_id", "text"), none).collect()] == [0]


def test_character_counts_by_occurrence():
    words, times = ["abc", "a", "été", "x" * 90], np.array([3, 2, 1, 5])
    want = np.zeros(T.CODES**3, np.int64)
    for w, n in zip(words, times):
        c = [0, 0, *map(T.code, w), 0]
        for a, b, d in zip(c, c[1:], c[2:]):
            want[(a * T.CODES + b) * T.CODES + d] += n
    assert (T.trigram_counts(words, times) == want).all() and T.trigram_counts([], times[:0]).sum() == 0


def test_words_of_a_rare_language_are_learnt(make_docs, spark):
    rng = random.Random(10)
    plain = [f"word{chr(97 + i)}" for i in range(20)]
    name = lambda: "".join(rng.choice("bcdfglmnprstvz") + rng.choice("aeiou") for _ in range(4))
    rare, common = [name() for _ in range(3)], [name() for _ in range(150)]
    texts, labels = [], []
    for i in range(4000):
        words = [rng.choice(plain) for _ in range(10)]
        if i % 2:
            words += [rare[i // 2 % 3]] if i < 108 else rng.sample(common, 12)
        texts.append(" ".join([*words, str(i)]))
        labels.append((i, i % 2))
    model = T.learn(make_docs(texts), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {*rare, *common} <= set(model.features)  # each rare one stands in 0.9 % of the toxic texts
    rows = T.score(make_docs([" ".join([*plain[:9], rare[0]]), " ".join(plain[:10])]).select("doc_id", "text"), model)
    scores = [r["score"] for r in sorted(rows.collect())]
    assert scores[0] > scores[1]
