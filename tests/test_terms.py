import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import values
from opinara.operators import lda as L
from opinara.operators import terms as W
from opinara.operators import topics as T

RNG = np.random.default_rng(3)
TEXTS = [[f"w{'abcdefghijklmnopqrstuvwxyz'[min(25, int(x))]}" for x in RNG.exponential(4, n % 23)] for n in range(120)] + [[], ["wa"], None]


@pytest.fixture(scope="module")
def corpus(spark):
    """Lists of words, some empty, in three partitions."""
    rows = spark.createDataFrame([(t,) for t in TEXTS], "tokens array<string>").repartition(3).persist()
    assert rows.count() == len(TEXTS)
    return T.topic_terms(rows)


@pytest.mark.parametrize("most", [5, 25, 60, 10_000])
def test_same_vocabulary_as_from_terms(corpus, monkeypatch, most):
    """Pairs that are not counted never enter; all pairs are, where the vocabulary has room."""
    monkeypatch.setattr(T, "MAX_FEATURES", most)
    monkeypatch.setattr(T.vocabulary_of, "__defaults__", (*T.vocabulary_of.__defaults__[:2], most))
    counts, by_words = T._counted(corpus.select(T.WORDS), len(TEXTS))
    rows, by_string = T._counted(corpus.select("terms"), len(TEXTS))
    assert by_words and not by_string
    for limits in ((T.SEARCH_MAX_DF, T.SEARCH_MIN_DF), (T.FINAL_MAX_DF, T.FINAL_MIN_DF)):
        want = values(T.vocabulary_of(rows, len(TEXTS), *limits))
        assert values(T.vocabulary_of(counts, len(TEXTS), *limits)) == want
    assert counts.count() < rows.count() if most == 5 else counts.count() == rows.count()
    monkeypatch.setattr(T, "LEMMAS_AT_ONCE", 0)
    many, _ = T._counted(corpus.select(T.WORDS), len(TEXTS), 0)  # too many words for the workers
    assert values(many) == values(rows)


def test_same_vectors_as_from_terms(spark, corpus):
    vocabulary = sorted(r["term"] for r in T.topic_vocabulary(corpus, 1.0, 1, 60).collect())
    assert any(" " in t for t in vocabulary)
    rows = T.vectorise(corpus.filter("terms IS NOT NULL"), vocabulary).select(F.unwrap_udt("features").alias("v"))
    want = [list(zip(r["v"]["indices"], r["v"]["values"])) for r in rows.collect()]
    words = corpus.filter("terms IS NOT NULL").select(T.WORDS)
    packed = W.packed_vectors(words, {"a": vocabulary, "b": [], "c": vocabulary}).collect()
    assert [[(int(i), float(n)) for i, n in np.frombuffer(r["a"], L.NARROW)] for r in packed] == want
    assert all(r["c"] == r["a"] and not r["b"] for r in packed)
    vectors, small = T.vectorise(corpus.filter("terms IS NOT NULL").coalesce(1), vocabulary), W.packed_vectors(words.coalesce(1), {"a": vocabulary})
    with L.held(vectors, "features") as wide, L.held(small, "a", len(vocabulary)) as narrow:
        assert L.PACKED[3] in narrow.columns and L.PACKED[3] not in wide.columns
        np.testing.assert_allclose(T._lda(3, 3).fit(wide).weights, T._lda(3, 3).fit(narrow).weights, rtol=1e-9)


def test_large_counts():
    entries = np.array([(1, 5), (2, 200_000), (0, 65_535), (3, 65_536)], L.ENTRY)
    ends = np.array([0, 1, 1, 3, 4])
    got, at = L._entries(L.bytes_of(entries, ends, L.NARROW), L.NARROW)
    rows = [{int(t): int(got[a:b]["count"][got[a:b]["term"] == t].sum()) for t in got[a:b]["term"]} for a, b in zip(at, at[1:])]
    assert rows == [{1: 5}, {}, {2: 200_000, 0: 65_535}, {3: 65_536}]


def test_search_goes_on_to_the_fit(corpus):
    """A fit that goes on from a model of the search is the fit from the beginning."""
    words = corpus.filter("terms IS NOT NULL").select(T.WORDS).coalesce(1)
    final, models = T.prepared(words).final, {}
    ready = T.Prepared(W.packed_vectors(words, {"search": final, "final": final}), len(TEXTS), final, final)
    k = T._choose(ready, 3, 4, 4, 3, models=models)
    assert set(models) == {3, 4}
    model, vocabulary = T._fit(ready, k, 7, models)
    np.testing.assert_allclose(model.weights, T._fit(ready, k, 7)[0].weights, rtol=1e-9)
    np.testing.assert_allclose(T._fit(ready, k, 2, models)[0].weights, T._fit(ready, k, 2)[0].weights, rtol=1e-9)
    other = ready._replace(final=final[1:], vectors=W.packed_vectors(words, {"final": final[1:]}))
    np.testing.assert_allclose(T._fit(other, k, 7, models)[0].weights, T._fit(other, k, 7)[0].weights, rtol=1e-9)


def test_no_words(spark):
    none = T.topic_terms(spark.createDataFrame([([],), (None,)], "tokens array<string>"))
    ready = T.prepared(none.select(T.WORDS))
    assert (ready.documents, ready.search, ready.final) == (2, [], [])
    assert T.fit_topics(none) is None and T.choose_topic_count(none) == 3
