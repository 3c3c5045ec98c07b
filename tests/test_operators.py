import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helpers import plan, values
from opinara.functions.lexicon import default_lexicon
from opinara.operators import dedup, quality
from opinara.operators import language as language_model
from opinara.plans.enrichment import enrich
from opinara.operators import sentiment as S
from opinara.operators.alerts import negative_spike_alert
from opinara.operators.keyed_join import join_small, join_unique
from opinara.operators.ranking import rank_by
from opinara.operators.statistics import bank_statistics, global_stats
from opinara.schemas import REVIEW

RAW = ("bank_name", "branch_name", "bank_rating", "bank_location", "review_date", "review_text", "review_rating")


def raw(spark, rows):
    return spark.createDataFrame(rows, REVIEW)


class TestDedup:
    def test_key_ignores_case_and_padding_and_rated_rows_win(self, spark):
        df = raw(spark, [
            ("CIH ", "A", None, "x, Rabat", "2024-01-01", "Bon service", None),
            ("cih", " a", "4,5", "x, Rabat", "2024-01-01", " bon SERVICE", None),
            ("cih", "a", None, "x, Rabat", "2024-01-01", "bon service ", 2),
            ("cih", "a", None, "x, Rabat", "2024-01-02", "bon service", None),
            ("cih", "a", None, "x, Rabat", None, "bon service", None),
            ("cih", "a", "1,0", "x, Rabat", None, "bon service", None),
        ])
        got = values(dedup.dedup_reviews(df), "review_date", "bank_rating", "review_rating")
        assert got == [("2024-01-01", None, 2), ("2024-01-02", None, None), (None, "1,0", None)]

    def test_ties_do_not_depend_on_row_order_and_repeat_is_stable(self, spark):
        rows = [("b", "a", f"{i},0", f"loc {i}", "2024-01-01", "same text", 3) for i in range(9, 0, -1)]
        first = values(dedup.dedup_reviews(raw(spark, rows)))
        random.Random(1).shuffle(rows)
        once = dedup.dedup_reviews(raw(spark, rows))
        assert values(once) == first == values(dedup.dedup_reviews(once))
        assert first[0][2] == "1,0"

    def test_groups_are_cut_before_the_shuffle(self, spark, sf_dir):
        from opinara.sources.reviews import reviews_raw

        text = plan(dedup.dedup_reviews(reviews_raw(spark, sf_dir)))
        exchange = text.index("Exchange hashpartitioning(_w0")
        assert "Partial" in text[exchange:]

    def test_top_k_and_links(self, spark):
        links = spark.createDataFrame(
            [("s", i, u) for i, u in enumerate("aabacdaab")] + [("t", 0, "z")], "s string, i int, u string"
        )
        assert len(values(dedup.top_k_per_group(links, ["s"], [F.col("i")], 3))) == 4
        assert values(dedup.cap_links(links, ["s"], "i", "u", 5)) == [
            ("s", "a", 0), ("s", "b", 2), ("s", "c", 4), ("t", "z", 0)]


class TestKeyedJoin:
    @pytest.mark.parametrize("how", ["left", "inner"])
    @pytest.mark.parametrize("share", [0.001, 0.2, 2.0])
    def test_same_as_plain_join_whatever_is_hot(self, spark, how, share):
        rng = random.Random(7)
        keys = ["hot"] * 300 + [f"k{rng.randrange(80)}" for _ in range(500)] + [None] * 100
        left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
        right = spark.createDataFrame(
            [(f"k{i}", i) for i in range(0, 60)] + [("hot", -1), (None, -2)], "k string, v int"
        )
        table = {f"k{i}": i for i in range(60)} | {"hot": -1, None: -2}
        want = [(k, i, table.get(k)) for i, k in enumerate(keys) if how == "left" or k in table]
        got = join_unique(left, right, ["k"], how, hot_share=share)
        assert values(got) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))

    def test_two_keys(self, spark):
        left = spark.range(200).select((F.col("id") % 3).alias("a"), (F.col("id") % 7).alias("b"), "id")
        right = left.select("a", "b").distinct().withColumn("v", F.col("a") * 10 + F.col("b"))
        got = join_unique(left, right, ["a", "b"], hot_share=0.05)
        assert got.count() == 200
        assert got.filter("v IS NULL OR v <> a * 10 + b").isEmpty()

    def test_small_sides_are_broadcast_only_within_the_limit(self, spark):
        left = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
        right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        assert "BroadcastHashJoin" in plan(join_small(left, right, ["k"]))
        got = join_small(left, right, ["k"], max_rows=10)
        assert got.filter("v = k * 2").count() == 1000


class TestRanking:
    @pytest.mark.parametrize("part", [[], ["g"]])
    def test_ranges_agree_with_one_window(self, spark, part):
        rng = random.Random(3)
        rows = [(rng.choice("abc"), rng.choice([None, 1.0, 2.5, rng.randrange(40) / 4]), i) for i in range(600)]
        rows += [("a", 5.0, 1000 + i) for i in range(300)]
        df = spark.createDataFrame(rows, "g string, v double, i int")
        got = rank_by(df, "v", "r", part, buckets=8, one_window_rows=0)
        want = df.withColumn("r", F.rank().over(W.partitionBy(*part).orderBy(F.desc_nulls_first("v"))))
        assert values(got, "i", "r") == values(want, "i", "r")

    def test_few_values(self, spark):
        df = spark.createDataFrame([(1.0,), (1.0,), (0.0,)], "v double")
        assert values(rank_by(df, "v", "r", one_window_rows=0)) == [(0.0, 3), (1.0, 1), (1.0, 1)]


class TestStatistics:
    def test_rated_rows_only_and_global_rollup(self, spark):
        rows = [("a", 5, "4.0", 10, 50.0), ("a", 2, None, 20, 70.0), ("a", None, "1.0", 99, 1.0), ("b", None, "2.0", 5, 5.0)]
        df = spark.createDataFrame(rows, "bank_name string, r int, br string, n int, p double").select(
            "bank_name", F.col("r").alias("review_rating_clean"),
            F.col("br").cast("decimal(3,2)").alias("bank_rating_decimal"),
            F.col("n").alias("normalized_length"), F.col("p").alias("retention_percentage"),
        )
        got = bank_statistics(df).collect()
        assert len(got) == 1
        r = got[0].asDict()
        assert (r["avg_rating"], r["rating_count"], r["min_rating"], r["max_rating"]) == (3.5, 2, 2, 5)
        assert (r["avg_bank_rating"], r["avg_text_length"], r["avg_retention"]) == (4.0, 15.0, 60.0)
        assert r["rating_stddev"] == pytest.approx(2.1213203)
        assert tuple(global_stats(df).first()) == (3.5, 4.0, 15.0)


class TestQuality:
    def test_checks(self, spark):
        df = spark.createDataFrame([("1", "a"), ("1", None), (None, "b"), ("2", "c")], "id string, bank_name string")
        assert values(quality.dq_not_null(df, ["id", "bank_name"])) == [("bank_name", 1), ("id", 1)]
        assert values(quality.dq_unique(df, "id")) == [("1", 2)]

    def test_sentiment_contradictions(self, spark):
        rows = [("positive", -0.5), ("negative", 0.5), ("positive", 0.5), (None, 0.1), ("neutral", None)]
        df = spark.createDataFrame(rows, "sentiment string, sentiment_score double")
        assert tuple(quality.validate_sentiment(df).first()) == (1, 1, 1, 1)

    def test_profiles(self, spark):
        df = spark.createDataFrame([("fr",), ("fr",), ("en",), (None,)], "language string")
        assert values(quality.value_profile(df, "language")) == [("en", 1, 25.0), ("fr", 2, 50.0), (None, 1, 25.0)]
        text = spark.createDataFrame([("abc", 0.5), (" ", 1.0), (None, 0.0)], "t string, c double")
        got = quality.column_profile(text, "t", F.filter(F.split(F.coalesce("t", F.lit("")), " "), lambda w: w != ""), "c")
        assert tuple(got.first()) == (3, 2, 2.0, 1, 2, 0.5)


class TestSentiment:
    CASES = [
        ("C'est un excellent service, je recommande vivement!", "fr", "positive"),
        ("This is a terrible experience, I hate it!", "en", "negative"),
        ("هذا منتج رائع جداً وأنصح به", "ar", "positive"),
        ("Service normal, rien d'exceptionnel", "fr", "neutral"),
        ("The product is okay, nothing special", "en", "neutral"),
        ("ok", "en", "unknown"), (None, "fr", "unknown"), ("worst bank", "other", "negative"),
    ]

    @pytest.mark.parametrize("method", ["row", "join"])
    def test_examples(self, spark, method):
        df = spark.createDataFrame(self.CASES, "final_text string, language string, want string")
        got = S.analyze_sentiment(df, default_lexicon(spark), method=method)
        assert got.filter("sentiment <> want").collect() == []
        assert got.count() == len(self.CASES)
        assert got.filter("sentiment = 'unknown' AND sentiment_score <> 0").isEmpty()

    def test_methods_agree_also_on_a_hot_text(self, spark):
        base = [("good good bad service", "en"), ("nul et lent", "fr"), ("", "en"), ("rien", "fr")]
        rows = [(i, *base[0 if i % 3 else i % 4]) for i in range(120)]
        df = spark.createDataFrame(rows, "i int, final_text string, language string")
        a = S.analyze_sentiment(df, default_lexicon(spark), method="row")
        for limit in (1000, 0):
            b = S.analyze_sentiment(df, default_lexicon(spark), method="join", broadcast_rows=limit)
            assert values(a) == values(b, *a.columns)
        # Two hits of +1.9 and one of -2.5; mean polarity (0.7 + 0.7 - 0.7) / 3.
        want = 0.6 * 1.3 / (1.3 ** 2 + 15) ** 0.5 + 0.4 * 0.7 / 3
        assert a.filter("i = 1").first()["sentiment_score"] == round(want, 3)

    def test_short_lexicon_needs_no_shuffle(self, spark, sf_dir):
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
            F.col("text").alias("final_text"), F.col("lang").alias("language"))
        text = plan(S.analyze_sentiment(docs, default_lexicon(spark)))
        assert "Exchange" not in text and "Python" not in text

    def test_middling_lexicon_needs_no_shuffle(self, spark, monkeypatch):
        base = [("good good bad service", "en"), ("nul et lent", "fr"), ("", "en"), ("rien", "fr"), (None, "fr"),
                ("خدمة ممتازة", "ar"), ("Bad, GOOD été", None), ("gut", "other")]
        rows = [(i, *base[i % len(base)]) for i in range(40)]
        df = spark.createDataFrame(rows, "i int, final_text string, language string")
        want = values(S.analyze_sentiment(df, default_lexicon(spark), method="row"))
        monkeypatch.setattr(S, "MAX_TERMS", 3)
        found = S.analyze_sentiment(df, default_lexicon(spark))
        assert "Exchange" not in plan(found) and values(found) == want
        assert values(S.analyze_sentiment(df, default_lexicon(spark), broadcast_rows=3), *found.columns) == want

    def test_texts_nobody_reads_are_not_shuffled(self, spark):
        df = spark.range(50).select("id", F.lit("en").alias("language"), F.concat(F.lit("good bad w"), F.col("id")).alias("final_text"))
        found = S.analyze_sentiment(df, default_lexicon(spark), method="join", broadcast_rows=0).select("id", "sentiment_score")
        tree = found._jdf.queryExecution().optimizedPlan().toString()
        joined = tree.split("Join", 1)
        assert len(joined) == 2 and "final_text" not in joined[0]
        assert "AS final_text" not in joined[1].split("Project", 1)[0]

    def test_long_lexicons_are_joined(self, spark):
        lex = spark.range(S.MAX_TERMS + 1).select(
            F.lit("en").alias("lang"), F.lit("polarity").alias("source"),
            F.concat(F.lit("w"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("term"),
            F.lit(-1.0).alias("weight"))
        df = spark.createDataFrame([("wb wc zz", "en")], "final_text string, language string")
        assert S.analyze_sentiment(df, lex).first()["sentiment_score"] == -0.4
        with pytest.raises(ValueError):
            S.analyze_sentiment(df, lex, method="row")

    def test_thresholds_use_the_exact_value(self, spark):
        df = spark.createDataFrame([(0.1,), (0.1001,), (-0.1,), (-0.1004,), (0.0,)], "p double")
        label, score = S.classify_polarity("p")
        got = [tuple(r) for r in df.select(label.alias("l"), score.alias("s")).collect()]
        assert got == [("neutral", 0.1), ("positive", 0.1), ("neutral", -0.1), ("negative", -0.1), ("neutral", 0.0)]

    def test_user_model_scores_arabic(self, spark):
        def load():
            return lambda texts: [("POSITIVE", 0.9) if "جيد" in t else ("negative", 0.8) for t in texts]

        df = spark.createDataFrame([("جيد جدا", "ar"), ("بطيء جدا", "ar"), ("good day", "en")],
                                   "final_text string, language string")
        model = S.model_score(load)
        got = values(S.analyze_sentiment(df, default_lexicon(spark), arabic_score=model), "language", "sentiment_score")
        assert got[:2] == [("ar", -0.8), ("ar", 0.9)]

        def broken():
            raise OSError("no model")

        none = S.model_score(broken, on_missing="zero")
        got = S.analyze_sentiment(df.filter("language = 'ar'"), default_lexicon(spark), arabic_score=none)
        assert values(got, "sentiment", "sentiment_score") == [("neutral", 0.0)] * 2
        with pytest.raises(Exception, match="no model"):
            S.analyze_sentiment(df, default_lexicon(spark), arabic_score=S.model_score(broken)).collect()

    def test_the_classifier_gets_arabic_texts_only(self, spark):
        def load():
            def classify(texts):
                assert all("\u0600" <= t[0] <= "\u06ff" for t in texts), texts
                return [("pos", 0.5)] * len(texts)

            return classify

        df = spark.createDataFrame([("جيد جدا", "ar"), ("good day", "en"), ("bon jour", "fr"), (None, "ar")],
                                   "final_text string, language string")
        for method in ("row", "join"):
            got = S.analyze_sentiment(df, default_lexicon(spark), arabic_score=S.model_score(load), method=method)
            assert values(got.filter("language = 'ar'"), "sentiment_score") == [(0.0,), (0.5,)]

    def test_routes_agree_on_repeated_halfway_and_null_weights(self, spark):
        lex = [("fr", "polarity", "mot", 0.5), ("fr", "polarity", "mot", -0.5), ("fr", "polarity", "demi", 0.10005),
               ("fr", "polarity", "vide", None), (None, "polarity", "mot", 1.0), ("fr", "polarity", None, 1.0),
               ("en", "intensity", "word", 2.00005), ("en", "polarity", "word", None), ("en", "intensity", "word", -3.0)]
        df = spark.createDataFrame([("mot mot",  "fr"), ("demi", "fr"), ("vide mot demi", "fr"), ("word", "en"), ("none", "en")],
                                   "final_text string, language string")
        ddl = "lang string, source string, term string, weight double"
        seen = set()
        for rows in (lex, lex[::-1], lex[4:] + lex[:4]):
            for method in ("row", "join"):
                got = S.analyze_sentiment(df, spark.createDataFrame(rows, ddl), method=method)
                seen.add(tuple(values(got, "final_text", "sentiment", "sentiment_score")))
        assert len(seen) == 1
        assert {r[0]: r[1] for r in seen.pop()} == {
            "mot mot": "positive", "demi": "positive", "vide mot demi": "positive", "word": "positive", "none": "neutral"}


    def test_labels_and_scores_at_halves(self, spark):
        halves = [-0.057499999999999996, 0.0575, 0.1, 0.10000000000000002, -0.1, 0.1000000009, -0.1000000011, 0.0005, None]
        df = spark.createDataFrame([(i, x) for i, x in enumerate(halves)], "i int, p double")
        label, score = S.classify_polarity("p")
        assert [(r["l"], r["s"]) for r in df.select("i", label.alias("l"), score.alias("s")).orderBy("i").collect()] == [
            ("neutral", -0.058), ("neutral", 0.058), ("neutral", 0.1), ("neutral", 0.1), ("neutral", -0.1),
            ("positive", 0.1), ("negative", -0.1), ("neutral", 0.001), ("neutral", None)]


class TestLanguageModel:
    def test_learns_and_stays_unsure_of_noise(self, spark):
        rows = [(f"le service de la banque est très bon et rapide {i}", "fr") for i in range(20)]
        rows += [(f"the service of this bank was very good and quick {i}", "en") for i in range(20)]
        rows += [(f"der dienst dieser bank ist sehr gut und schnell {i}", "de") for i in range(20)]
        model = language_model.fit_language_model(spark.createDataFrame(rows, "text string, lang string"))
        new = spark.createDataFrame(
            [("le banquier est très rapide",), ("the banker was very quick",), ("der dienst ist schnell",),
             ("خدمة",), (None,), ("ab",)], "final_text string")
        got = [r["language"] for r in language_model.add_language(new, model=model).collect()]
        assert got == ["fr", "en", "other", "ar", "unknown", "unknown"]
        probs = language_model.apply_language_model(
            spark.createDataFrame([("zq",), ("le banquier est très rapide",)], "final_text string"), model
        ).collect()
        assert probs[0]["model_prob"] < 0.7 < probs[1]["model_prob"] <= 1.0


    def test_model_is_a_bounded_table(self, spark):
        rows = [("aaa bbb", "x"), ("aaa ccc", "y"), ("ab", "x"), (None, "x"), ("ddd", None)]
        labelled = spark.createDataFrame(rows, "text string, lang string")
        model = language_model.fit_language_model(labelled, size=3)
        assert model.count() == 6 and model.select("trigram").distinct().count() == 3
        assert values(model.filter("trigram = ' aa'"), "language", "weight") == [("x", -1253), ("y", -1253)]
        seen = language_model.apply_language_model(
            spark.createDataFrame([("aaa",), ("qqq",), ("",), (None,)], "final_text string"), model).collect()
        # equal sums: the first by name; no trigram of the model: no language
        assert [(r["model_lang"], r["model_prob"]) for r in seen] == [("x", 0.5), (None, 0.0), (None, 0.0), (None, 0.0)]
        empty = language_model.fit_language_model(labelled.limit(0))
        assert empty.count() == 0
        assert language_model.apply_language_model(labelled.select("text"), empty, "text").filter("model_prob > 0").isEmpty()

    def test_built_in_model(self, spark):
        model = language_model.default_language_model(spark)
        reviews = [
            ("le personnel de cette agence est vraiment très accueillant", "fr"), ("the people at this counter were very helpful", "en"),
            ("el personal de esta oficina es muy amable y rápido", "other"), ("die mitarbeiter sind immer sehr freundlich", "other"),
            ("خدمة ممتازة", "ar"), ("ok", "unknown"), (None, "unknown")]
        df = spark.createDataFrame(reviews, "final_text string, want string")
        got = enrich(df)
        assert values(got, "final_text", "language") == sorted(reviews, key=lambda r: (r[0] is None, str(r[0])))
        assert model.select("language").distinct().count() == 6


class TestAlerts:
    def test_windows_with_many_negatives(self, spark):
        rows = [("2024-01-01 10:00:00", "n")] * 4 + [("2024-01-01 11:00:00", "p")] * 6
        rows += [("2024-01-02 10:00:00", "n")] * 2 + [("2024-01-03 09:00:00", "n")] * 5
        df = spark.createDataFrame(rows, "t string, s string").select(F.col("t").cast("timestamp").alias("ts"), "s")
        got = negative_spike_alert(df, "ts", F.col("s") == "n", min_share=0.4, min_count=5)
        assert [(str(a)[:10], n, k, s) for a, _, n, k, s in values(got)] == [
            ("2024-01-01", 10, 4, 0.4), ("2024-01-03", 5, 5, 1.0)]
        sliding = negative_spike_alert(df, "ts", F.col("s") == "n", window="2 days", slide="1 day", min_share=0.9, min_count=1)
        assert sliding.count() == 2
