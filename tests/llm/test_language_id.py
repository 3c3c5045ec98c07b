import itertools
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from opinara.llm import language_id as L
from opinara.llm import tokens, wordcache
from opinara.llm import words as W

from .conftest import ODD_TEXTS


def by_enumeration(word, names, p, unknown):
    """Sum over all cuts of ``word`` and its end."""
    units = [*word, "</w>"]
    total = 0.0
    for cuts in itertools.product([False, True], repeat=len(units) - 1):
        at, product = 0, 1.0
        for end in [i + 1 for i, c in enumerate(cuts) if c] + [len(units)]:
            piece = "".join(units[at:end])
            product *= p.get(piece, 0) + (unknown if end - at == 1 else 0)
            at = end
        total += product
    return total


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(2)
    names = ["a", "b", "ab", "ba", "aba", "b</w>", "ab</w>", "</w>", "é", "éa"]
    pieces = L.Pieces(names)
    p = np.vstack([rng.random((len(names), 2)), np.zeros(2)])
    unknown = np.array([0.01, 0.02])
    for word in ["a", "ab", "abab", "babaé", "éaéa", "xyz"]:
        points = L.word_points(word, 0, 99)[None]
        got = L.forward(points, pieces, p, unknown)[0, -1]
        want = [by_enumeration(word, names, dict(zip(names, p[:, k])), unknown[k]) for k in range(2)]
        assert got == pytest.approx(want)
        uses = L.expected(points, np.ones((1, 2)), pieces, p, unknown)
        for k in range(2):  # the derivative of log P with respect to log p
            more = p.copy()
            more[1, k] *= 1 + 1e-6
            slope = (np.log(L.forward(points, pieces, more, unknown)[0, -1, k]) - np.log(got[k])) / 1e-6
            assert uses[1, k] == pytest.approx(slope, abs=1e-4)


def test_pieces_are_found_in_a_crowded_table(monkeypatch):
    monkeypatch.setattr(L, "SLOTS", 6)
    names = ["".join(x) for x in itertools.product("abcdef", repeat=3)]
    pieces = L.Pieces(names)
    for i in range(0, len(names), 7):
        assert pieces.find(pieces.hashes[i : i + 1])[0] == i
    assert pieces.find(np.array([12345], np.uint64))[0] == len(names)


def test_no_piece_of_the_vocabulary_is_left_out_for_its_length():
    pieces = L.Pieces.of_vocabulary(tokens.path())
    names = set(pieces.names)
    assert {"artificialintelligence</w>", "transformationtuesday</w>", "the</w>"} <= names and pieces.longest > 20
    place = pieces.names.index("artificialintelligence</w>")
    probability = np.zeros((len(pieces.names) + 1, 1))
    probability[place] = 0.25
    points = L.word_points("artificialintelligence", 0, 99)[None]
    assert L.forward(points, pieces, probability, np.array([0.0]))[0, -1] == pytest.approx([0.25])


def test_long_words_are_learnt_to_their_end(spark, make_docs):
    known = make_docs(["a" * L.MAX_WORD + "qqqqqqqq"] * 3)
    pieces = L.Pieces.of_vocabulary(tokens.path())
    model = L.learn(known, tokens.path(), rounds=0)
    assert model.probability[pieces.names.index("q"), 0] > 100 * model.probability[pieces.names.index("z"), 0]


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = L.learn(docs.filter(wordcache.remainder("doc_id", 4) != 2), tokens.path(), rows=20)
    rows = L.predict(docs.filter(wordcache.remainder("doc_id", 4) == 2).select("doc_id", "lang", "text"), model, tokens.path()).collect()
    assert len(rows) > 30 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows_and_empty_tables(make_docs):
    rng = random.Random(0)
    known = make_docs([" ".join(rng.choice(["the", "cat", "thing"]) for _ in range(30)) for _ in range(9)])
    model = L.learn(known, tokens.path())
    rows = L.predict(make_docs([*ODD_TEXTS, "123 !!", "x" * 500]).select("doc_id", "source", "text"), model, tokens.path()).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ODD_TEXTS) + 2 and all(r["source"] == "src0" for r in rows)
    assert [by_id[i]["lang_pred"] for i in (0, 1, 2, len(ODD_TEXTS))] == ["und"] * 4
    assert by_id[5]["lang_pred"] == by_id[len(ODD_TEXTS) + 1]["lang_pred"] == "en" and by_id[5]["score"] == 1
    nothing = L.learn(make_docs([]), tokens.path())
    assert [r["lang_pred"] for r in L.predict(make_docs(["abc"]).select("doc_id", "text"), nothing, tokens.path()).collect()] == ["und"]
    assert L.predict(make_docs([]).select("doc_id", "text"), model, tokens.path()).count() == 0


def test_texts_of_one_group_at_a_time_are_python_strings():
    texts = ["ab", None, "", "é" * 9, "x" * 30, "日本語", None]
    for size in (1, 5, 12, 100):
        for column in (pa.array(texts), pa.array(["skipped", *texts]).slice(1), pa.array(texts[:0], pa.string())):
            assert list(W.column_groups(column, size)) == list(W.groups(column.to_pylist(), size))


def test_a_batch_of_many_texts_takes_little_memory():
    model = L.Model(["en"], np.full((len(L.Pieces.of_vocabulary(tokens.path()).names) + 1, 1), 1e-5), np.full(1, 1e-9), "little")
    made = []
    docs = SimpleNamespace(
        columns=["doc_id", "text"], schema=[], mapInArrow=lambda run, ddl: made.append(run),
        sparkSession=SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x))))
    L.predict(docs, model, tokens.path(), keep_text=True)

    def peak(n):
        batch = pa.RecordBatch.from_pydict({"doc_id": range(n), "text": ["one or two words " * 2_000] * n})
        tracemalloc.start()
        assert sum(len(b) for b in made[0](iter([batch]))) == n
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    peak(1)
    assert peak(1_800) < 1.2 * peak(180)  # 61 and 6 million characters, 2 million in a group


def test_bounded_sample(spark):
    ids = spark.range(20_000).selectExpr("id AS doc_id", "if(id % 50 = 0, 'rare', if(id = 7, 'once', 'often')) AS lang")
    got = dict(wordcache.bounded_sample(ids, "lang", 300).groupBy("lang").count().collect())
    assert got == {"rare": 300, "once": 1, "often": 300}


def test_signs_are_no_letters(spark, make_docs):
    assert [L.has_letter(t) for t in ("²", "½ 3", "_9", "a", "²é", "日", "", "ª")] == [False, False, False, True, True, True, False, True]
    model = L.learn(make_docs(["some words here", "more words there"] * 3), tokens.path(), rounds=1)
    docs = make_docs(["x² ½", "² ½", "words"])
    rows = L.predict(docs.select("doc_id", "text"), model, tokens.path()).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in rows] == ["en", "und", "en"]
    kept = L.predict(docs.selectExpr("text", "doc_id AS score", "doc_id AS other"), model, tokens.path(), keep_text=True)
    assert sorted(kept.columns) == ["lang_pred", "other", "score", "text"]
    assert sorted(r["text"] for r in kept.collect()) == sorted(["x² ½", "² ½", "words"])
