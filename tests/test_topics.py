import pytest
from pyspark.sql import functions as F

from helpers import plan, values
from opinara.operators import topics as T
from opinara.sources.scratch import write_once


@pytest.fixture(scope="module")
def reviews(spark):
    themes = ["carte bancaire paiement refus distributeur", "accueil sourire personnel aimable guichet"]
    rows = [
        (f"r{i}", f"{themes[i % 2]} {themes[i % 2].split()[i % 5]} mot{'abcdefghij'[i % 10]}") for i in range(80)
    ]
    return spark.createDataFrame(rows + [("short", "ok"), ("thin", "banque banque carte")], "id string, final_text string")


@pytest.fixture(scope="module")
def corpus(reviews):
    return write_once(T.topic_terms(T.prepare_corpus(reviews)), "test_corpus")


def test_corpus_drops_short_and_thin_texts(corpus):
    assert corpus.count() == 80


def test_vocabulary_limits(spark):
    docs = spark.createDataFrame(
        [(["a", "b", "a"],), (["a", "b"],), (["a", "c"],), (["a", "d", "c", "c"],)], "terms array<string>")
    got = [tuple(r) for r in T.topic_vocabulary(docs, max_df=0.75, min_df=2, max_features=10).collect()]
    assert got == [("c", 3, 2), ("b", 2, 2)]
    assert [r[0] for r in T.topic_vocabulary(docs, 1.0, 1, 2).collect()] == ["a", "c"]


@pytest.mark.parametrize("ks,perplexities,want", [
    ([3, 4, 5], [100.0, 90.0, 88.0], 4), ([3, 4, 5], [100.0, 80.0, 60.0], 5),
    ([3, 4], [100.0, 99.0], 4), ([], [], 3), ([3, 4, 5], [100.0, 98.0, 50.0], 3),
    ([3, 4, 5, 6], [100.0, float("nan"), 80.0, 79.0], 5),
])
def test_topic_count_rule(ks, perplexities, want):
    assert T.pick_topic_count(ks, perplexities) == want


@pytest.mark.parametrize("curve", [
    [100.0, 90.0, 89.0, 50.0], [100.0, 80.0, 60.0, 45.0], [100.0, 99.0], [float("nan"), 100.0, 99.0, 20.0, 10.0],
    [100.0, 99.0, float("inf")], [],
])
def test_rule_over_a_table_and_early_exit(spark, monkeypatch, curve):
    """The table rule, and the search that stops early, choose what the rule chooses on the whole curve."""
    ks = list(range(3, 3 + len(curve)))
    rows = [("c", k, p) for k, p in zip(ks, curve)]
    table = spark.createDataFrame(rows, "corpus string, topic_count int, perplexity double")
    want = T.pick_topic_count(ks, curve, -1)
    assert [r["topic_count"] for r in T.pick_topic_counts(table, ["corpus"]).collect()] == ([want] if rows else [])
    fitted = []

    class Model:
        def __init__(self, k):
            self.k = k

        def fit(self, vectors):
            fitted.append(self.k)
            return self

        def logPerplexity(self, vectors):
            p = curve[self.k - 3]
            return float("nan") if p != p else T.math.log(p)

    monkeypatch.setattr(T, "_lda", lambda k, *a: Model(k))
    monkeypatch.setattr(T.math, "exp", lambda x, e=T.math.exp: x if x != x else round(e(x), 6))
    for at_once in (1, 2, 3):
        found = T.search_topic_counts(table, ks, 1, at_once)
        assert T.pick_topic_count([k for k, _ in found], [p for _, p in found], -1) == want
    fitted.clear()
    T.search_topic_counts(table, ks, 1, 1)
    assert fitted == ks[:3] if curve[:1] == [100.0] and len(curve) == 4 and curve[1] == 90.0 else set(fitted) <= set(ks)


def test_vector_rows(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "b", "zz"]), (2, []), (3, ["c"])], "id int, terms array<string>")
    vectors = T.vectorise(docs, ["a", "b", "c"]).select("id", "features")
    assert values(T.vector_rows(vectors, ["a", "b", "c"])) == [(1, "a", 1), (1, "b", 2), (3, "c", 1)]


def test_default_topic_count():
    assert [T.default_topic_count(n) for n in (0, 120, 10_000)] == [3, 4, 8]


def test_model_separates_themes_and_repeats(spark, reviews, corpus):
    first = T.fit_topics(corpus, 2, iterations=10)
    second = T.fit_topics(corpus, 2, iterations=10)
    labels = T.label_topics(T.topic_words(*first))
    assert labels.count() == 2
    a = T.assign_topics(corpus, first, labels)
    assert values(a, "id", "topic_id", "topic_confidence") == values(
        T.assign_topics(corpus, second), "id", "topic_id", "topic_confidence")
    assert a.filter("topic_confidence <= 0 OR topic_confidence > 1").isEmpty()
    assert a.count() == 80
    split = a.groupBy(F.contains("final_text", F.lit("carte")).alias("card")).agg(
        F.countDistinct("topic_id").alias("n")).collect()
    assert [r["n"] for r in split] == [1, 1]


def test_early_choice_is_the_whole_choice(corpus):
    assert T.choose_topic_count(corpus, max_topics=7, iterations=3) == T.choose_topic_count(
        corpus, max_topics=7, iterations=3, whole=True)


def test_search_stays_in_range(corpus):
    assert 3 <= T.choose_topic_count(corpus, max_topics=4, iterations=3) <= 4


def test_whole_step_keeps_every_review(reviews):
    got = T.extract_topics(reviews, k=2, iterations=3)
    assert got.count() == reviews.count()
    rest = got.filter("id IN ('short', 'thin')")
    assert values(rest, "topic_id", "topic_name", "topic_confidence") == [(-1, "Unclassified", 0.0)] * 2


def test_untrained_model(corpus):
    got = T.assign_topics(corpus.select("id"), None).first()
    assert (got["topic_id"], got["topic_name"], got["topic_confidence"]) == (-1, "Model_Error", 0.0)


def test_no_vocabulary(spark):
    docs = spark.createDataFrame([(["x"],)], "terms array<string>")
    assert T.fit_topics(docs) is None
    assert T.choose_topic_count(docs) == 3


@pytest.mark.parametrize("words,want", [
    (["temps", "carte bleue", "agence"], "Card_Services"),
    (["services", "carte"], "Service_Quality"),
    (["aa", "bb", "cc", "dd", "ee", "service"], "Aa_Bb"),
    (["guichet", "la", "file longue"], "Guichet_File Longue"),
    (["guichet", "la", "et"], "Guichet"), (["ab"], "Ab"), (["ab", "cd"], "Ab_Cd"),
])
def test_labels(spark, words, want):
    df = spark.createDataFrame([(0, i, w) for i, w in enumerate(words)], "topic_id int, rank int, word string")
    assert values(T.label_topics(df)) == [(0, want)]


def test_merge_does_not_multiply_repeated_ids(spark):
    original = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "id string, n int")
    assigned = spark.createDataFrame(
        [("a", 1, "X", 0.5), ("a", 1, "X", 0.5), ("b", 0, "Y", 0.9)],
        "id string, topic_id int, topic_name string, topic_confidence double")
    got = values(T.merge_topics(original, assigned), "id", "n", "topic_id", "topic_name", "topic_confidence")
    assert got == [("a", 1, 1, "X", 0.5), ("a", 2, 1, "X", 0.5), ("b", 3, 0, "Y", 0.9),
                   ("c", 4, -1, "Unclassified", 0.0)]


def test_lemmas_keep_word_order(spark):
    rows = [("1", ["cartes", "perdues", "cartes"]), ("2", [])]
    df = spark.createDataFrame(rows, "id string, tokens array<string>")
    lemmas = spark.createDataFrame([("cartes", "carte")], "token string, lemma string")
    assert values(T.lemmatise(df, lemmas), "id", "tokens") == [("1", ["carte", "perdues", "carte"]), ("2", [])]


def test_lemmas_with_repeated_ids_and_several_lemmas(spark):
    df = spark.createDataFrame([("1", ["cartes", "x"]), ("1", ["y", "cartes"]), ("1", ["y", "cartes"])], "id string, tokens array<string>")
    lemmas = spark.createDataFrame([("cartes", "carte"), ("cartes", "quarte"), ("x", None), (None, "z")], "token string, lemma string")
    assert values(T.lemmatise(df, lemmas), "tokens") == [(["carte", "x"],), (["y", "carte"],), (["y", "carte"],)]


def test_lemma_tables_are_looked_up_without_a_shuffle(spark):
    lists = [["cartes", "x", "cartes"], [], None, ["y"], ["x", None, "cartes"]] * 9
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "id int, tokens array<string>")
    lemmas = spark.createDataFrame([("cartes", "carte"), ("x", "cartes"), ("x", "z")], "token string, lemma string")
    found = T.lemmatise(df, lemmas)
    assert "Exchange" not in plan(found)
    of = {"cartes": "carte", "x": "cartes"}
    want = {i: None if t is None else [of.get(x, x) for x in t] for i, t in enumerate(lists)}
    assert {r["id"]: r["tokens"] for r in found.collect()} == want
    assert {r["id"]: r["tokens"] for r in T.lemmatise(df, lemmas, at_once=0).collect()} == want
    none = T.lemmatise(df, lemmas.filter("false"))
    assert {r["id"]: r["tokens"] for r in none.collect()} == dict(enumerate(lists))


def test_registered_query_runs_the_whole_step(monkeypatch):
    from opinara.plans import catalog

    calls = []
    monkeypatch.setattr(catalog, "staged", lambda spark, d: "reviews")
    monkeypatch.setattr(catalog.topics, "extract_topics", lambda *a, **options: calls.append((a, options)) or _Frame())
    catalog.QUERIES["assign_topics"](None, "")
    assert calls == [(("reviews",), {})]  # all defaults: the search and 50 iterations


class _Frame:
    def select(self, *columns):
        return self


def test_long_lemma_tables_take_no_list_apart(spark, monkeypatch):
    """Lists of many chunks against a table that is too long to be sent; repeated, empty and null lists, null words."""
    monkeypatch.setattr(T, "CHUNK_TOKENS", 40)
    lists = [[f"w{(i * j) % 37}" if j % 9 else None for j in range(i % 14)] for i in range(90)] + [None, [], ["w1"], ["w1"]] * 5
    df = spark.createDataFrame([(i % 50, t) for i, t in enumerate(lists)], "id int, tokens array<string>").repartition(3)
    lemmas = spark.createDataFrame([(f"w{i}", f"l{i}") for i in range(0, 37, 2)] + [("w2", "z")], "token string, lemma string")
    written = []

    def write(table, label, one=T.write_once):
        written.append((label, table))
        return one(table, label)

    monkeypatch.setattr(T, "write_once", write)
    found = T.lemmatise(df, lemmas, at_once=0)
    of = {f"w{i}": f"l{i}" for i in range(0, 37, 2)}
    want = sorted(((i % 50, None if t is None else [of.get(x, x) for x in t]) for i, t in enumerate(lists)), key=str)
    assert sorted(((r["id"], r["tokens"]) for r in found.collect()), key=str) == want
    assert [label for label, _ in written] == ["lemma_table", "token_lists", "list_keys", "lemmas"]  # no table has a row per word
    assert found.columns == df.columns
