import datetime as dt
import decimal
import hashlib

import pytest
from pyspark.sql import functions as F

from helpers import column, values
from opinara.functions import dates, geo, keys, language, ratings, topics, wordlists
from opinara.functions import text as X


class TestText:
    def test_basic_cleaning(self, spark):
        got = column(spark, [
            "  L'Accueil  est TRÈS bon !! 10/10 ", None, "   ", "Œuvre naïve\tö ß\nfin", "123", "\n",
        ], X.clean_text_basic("c"))
        assert got == ["l accueil est très bon", None, None, "œuvre naïve fin", "", ""]

    def test_basic_cleaning_can_keep_numbers(self, spark):
        assert column(spark, ["Note 10/10."], X.clean_text_basic("c", keep_numbers=True)) == ["note 10 10"]

    def test_arabic_is_blanked_unless_asked_for(self, spark):
        text = "خدمة ممتازة merci"
        assert column(spark, [text], X.clean_text_basic("c")) == ["merci"]
        assert column(spark, [text], X.clean_text_basic("c", scripts=("latin", "arabic"))) == [text]

    def test_digits_vanish_without_gap(self, spark):
        assert column(spark, ["a1b 22 c", "  7 "], X.clean_text_no_digits("c")) == ["ab c", ""]

    def test_stop_words_per_language(self, spark):
        text = "Le service de la banque is very good et rapide"
        fr = X.normalize_text("c", languages=["fr"])
        en = X.normalize_text("c", languages=["en"])
        none = X.normalize_text("c", remove_stopwords=False)
        assert column(spark, [text], fr) == ["service banque is very good rapide"]
        # "a", "is", "very" are English stop words, "le" and "la" are not.
        assert column(spark, [text], en) == ["le service de la banque good et rapide"]
        assert column(spark, [text], none) == ["le service de la banque is very good et rapide"]

    def test_arabic_stop_words(self, spark):
        norm = X.normalize_text("c", languages=["ar"], scripts=("latin", "arabic"))
        assert column(spark, ["البنك في المدينة"], norm) == ["البنك المدينة"]

    def test_negation_is_dropped_by_default(self, spark):
        text = "pas bien du tout, jamais aimable"
        assert column(spark, [text], X.normalize_text("c", languages=["fr"])) == ["aimable"]
        kept = X.normalize_text("c", languages=["fr"], keep_negation=True)
        assert column(spark, [text], kept) == ["pas bien jamais aimable"]

    def test_stop_words_only_gives_empty_text(self, spark):
        assert column(spark, ["le la les", "ab", "a"], X.normalize_text("c", min_length=3)) == ["", None, None]

    def test_stop_lists_have_the_expected_sizes(self):
        assert len(wordlists.french_stop_words()) == 372
        assert len(wordlists.stop_words("ar")) == 82
        assert len(wordlists.stop_words("en")) == 174
        assert {"whereas", "actuellement", "among", "attente"} <= set(wordlists.french_stop_words())

    def test_validity(self, spark):
        got = column(spark, [None, "", "  ab ", " abc ", "12 34"], X.is_valid_text("c"))
        assert got == [False, False, False, True, True]
        assert column(spark, ["12 34", "a12"], X.is_valid_text("c", allow_numbers=False)) == [False, True]

    def test_metrics(self, spark):
        df = spark.createDataFrame(
            [("abcdefgh", "abc"), ("abc", ""), ("", ""), ("abc", None)], "orig string, clean string"
        )
        got = df.select(
            X.retention_percentage("clean", "orig").alias("r"), X.word_count("clean").alias("w")
        ).collect()
        assert [tuple(r) for r in got] == [(37.5, 1), (0.0, None), (0.0, None), (None, 0)]

    def test_retention_rounds_half_up(self, spark):
        df = spark.createDataFrame([("a" * 16, "a")], "orig string, clean string")
        assert df.select(X.retention_percentage("clean", "orig")).first()[0] == 6.25
        df = spark.createDataFrame([("a" * 800, "a")], "orig string, clean string")
        assert df.select(X.retention_percentage("clean", "orig")).first()[0] == 0.13

    def test_text_choice_and_quality(self, spark):
        df = spark.createDataFrame(
            [(60.0, 3), (59.99, 3), (99.0, 2), (70.0, 9), (50.0, 9), (49.99, None)], "r double, w int"
        )
        got = df.select(
            X.select_text(F.lit("basic"), F.lit("short"), "r", "w").alias("t"), X.text_quality("r").alias("q")
        ).collect()
        assert [tuple(g) for g in got] == [
            ("short", "MEDIUM"), ("basic", "MEDIUM"), ("basic", "HIGH"), ("short", "HIGH"),
            ("basic", "MEDIUM"), ("basic", "LOW"),
        ]


class TestRatings:
    def test_decimal_comma(self, spark):
        got = column(spark, ["4,5", "3", None, "bad", "12,5", " 2,25 "], ratings.parse_decimal_comma("c"))
        D = decimal.Decimal
        assert got == [D("4.50"), D("3.00"), None, None, None, D("2.25")]

    def test_clamp(self, spark):
        assert column(spark, [0, 1, 5, 19, -2, None], ratings.clamp_rating("c"), "int") == [1, 1, 5, 5, 1, None]

    @pytest.mark.parametrize("own,avg,count,overall,want", [
        (4, 2.0, 9, 3.0, (4.0, "ORIGINAL")),
        (None, 2.25, 3, 3.0, (2.3, "BANK_AVERAGE")),
        (None, 2.0, 2, 3.44, (3.4, "GLOBAL_AVERAGE")),
        (None, None, None, None, (3.0, "DEFAULT")),
    ])
    def test_rating_ladder(self, spark, own, avg, count, overall, want):
        df = spark.createDataFrame([(own, avg, count, overall)], "o int, a double, n bigint, g double")
        rating, source = ratings.impute_rating(F.col("o"), F.col("a"), F.col("n"), F.col("g"))
        assert tuple(df.select(rating.alias("r"), source.alias("s")).first()) == want

    @pytest.mark.parametrize("own,avg,overall,want", [
        ("4.5", 2.0, 3.0, 4.5), ("-0.4", 2.04, 3.0, 2.0), ("5.01", None, 3.26, 3.3), (None, None, None, 3.0),
    ])
    def test_bank_rating_ladder(self, spark, own, avg, overall, want):
        df = spark.createDataFrame([(own, avg, overall)], "o string, a double, g double")
        got = ratings.impute_bank_rating(F.col("o").cast("decimal(3,2)"), F.col("a"), F.col("g"))
        assert df.select(got).first()[0] == want


class TestKeys:
    def test_review_id(self, spark):
        df = spark.createDataFrame([("B", None, "2024-01-02", "bon service")], "b string, r string, d string, t string")
        got = df.select(keys.review_id("b", "r", "d", "t")).first()[0]
        assert got == hashlib.md5(b"B2024-01-02bon service").hexdigest()

    def test_surrogate_key(self, spark):
        df = spark.createDataFrame([("x", None)], "a string, b int")
        got = df.select(keys.surrogate_key("a", "b")).first()[0]
        assert got == hashlib.md5(f"x-{wordlists.KEY_NULL_TOKEN}".encode()).hexdigest()

    def test_score_text(self, spark):
        got = column(spark, [0.5, -0.125, 0.0, 1.0, 10.0, 0.1], keys.score_text("c"), "double")
        assert got == ["0.5", "-0.125", "0", "1", "10", "0.1"]


class TestGeo:
    def test_raw_city(self, spark):
        got = column(spark, ["12 rue X, Hay Y,  Fès ", "no comma", None, "end,"], geo.raw_city("c"))
        assert got == ["Fès", None, None, ""]

    def test_city_and_region(self, spark):
        rows = [("a, CASABLANCA",), ("a, casa",), ("a, Kenitra",), ("a, Mohammédia",), ("a, Tata",), ("none",)]
        df = spark.createDataFrame(rows, "address string")
        got = values(geo.with_place(df, "address"), "address", "city", "region")
        assert got == sorted([
            ("a, CASABLANCA", "Casablanca", "Casablanca-Settat"),
            ("a, casa", "Casablanca", "Inconnue"),
            ("a, Kenitra", "Kénitra", "Inconnue"),
            ("a, Mohammédia", "Mohammédia", "Inconnue"),
            ("a, Tata", "Tata", "Inconnue"), ("none", None, "Inconnue"),
        ], key=str)
        by_city = dict(values(geo.with_place(df, "address", region_from_city=True), "address", "region"))
        assert by_city["a, casa"] == "Casablanca-Settat"
        assert by_city["a, Kenitra"] == "Rabat-Salé-Kénitra"


class TestDates:
    AS_OF = "2024-03-31"

    @pytest.mark.parametrize("said,want", [
        ("il y a 3 jours", "2024-03-28"), ("Il y a une semaine", "2024-03-24"),
        ("il y a un jour", None), ("2 mois", "2024-01-31"), ("un an", "2023-04-01"),
        ("hier", "2024-03-30"), ("Aujourd'hui", "2024-03-31"), ("yesterday", "2024-03-30"), ("", None),
        (None, None), ("il y a 2 années.", "2022-04-01"), ("modifié il y a 1 an", "2023-04-01"),
        ("il y a 5 heures", None), ("il y a 99999999999 ans", None), ("il y a 3000 ans", None),
    ])
    def test_relative(self, spark, said, want):
        got = column(spark, [said], dates.parse_relative_date("c", self.AS_OF))[0]
        assert (got.isoformat() if got else None) == want

    def test_extended(self, spark):
        said = ["il y a un jour", "il y a 5 heures", "il y a une minute", "il y a 3 mois"]
        got = column(spark, said, dates.parse_relative_date("c", self.AS_OF, extended=True))
        assert got == [dt.date(2024, 3, 30), dt.date(2024, 3, 31), dt.date(2024, 3, 31), dt.date(2024, 1, 1)]

    def test_date_text(self, spark):
        assert column(spark, ["2024-1-5", "2024-02-03 10:00:00", "x", None], dates.date_text("c")) == [
            "2024-01-05", "2024-02-03", None, None]


class TestLanguage:
    def test_indicators_match_as_substrings(self, spark):
        got = column(spark, ["place", "the end", "xyz", "or the de la"], language.language_by_indicators("c"))
        assert got == ["fr", "en", "unknown", "en"]

    def test_detection_order(self, spark):
        rows = [(None, "fr", 0.9), (" ab ", "fr", 0.9), ("شكرا", "fr", 0.9), ("bonjour", "fr", 0.71),
                ("bonjour", "de", 0.9), ("the car", "fr", 0.7), ("zzz", "fr", 0.2)]
        df = spark.createDataFrame(rows, "c string, l string, p double")
        got = [r[0] for r in df.select(language.detect_language("c", F.col("l"), F.col("p"))).collect()]
        assert got == ["unknown", "unknown", "ar", "fr", "other", "en", "unknown"]


class TestTopicTokens:
    def test_preprocessing(self, spark):
        got = column(spark, ["Très bon ACCUEIL à la banque, 24h! m'a plu", None, " "],
                     topics.preprocess_for_topics("c"))
        assert got == [["bon", "accueil", "plu"], [], []]

    def test_accented_words_vanish_or_fold(self, spark):
        tokens = F.split("c", " ")
        assert column(spark, ["crédit carte"], topics.model_words(tokens)) == [["carte"]]
        assert column(spark, ["crédit carte"], topics.model_words(tokens, True)) == [["credit", "carte"]]

    def test_bigrams(self, spark):
        got = column(spark, ["aa bb cc", "aa", ""], topics.with_bigrams(F.filter(F.split("c", " "), lambda t: t != "")))
        assert got == [["aa", "bb", "cc", "aa bb", "bb cc"], ["aa"], []]
