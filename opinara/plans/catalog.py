"""Named queries over the test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, geo, keys, language, ratings
from ..functions import text as X
from ..functions import topics as TF
from ..functions.lexicon import default_lexicon
from ..functions.wordlists import SEARCH_BANKS, TOPIC_RULES
from ..operators import alerts, dedup, quality, sentiment, topics
from ..operators import language as language_model
from ..operators import statistics as stats
from ..operators.keyed_join import join_unique
from ..plans import live, marts, reports, staging
from ..plans.enrichment import enrich
from ..schemas import REVIEW
from ..sources import pages as page_source
from ..sources import search, tables
from ..sources.reviews import documents, hash_number, reviews_from_documents, reviews_raw, table
from ..sources.scratch import write_once, new_folder
from ..streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF = "2025-07-22"

# Stand-in topic names for reports; real names come from the topic model.
TOPIC_NAMES = list(dict.fromkeys(label for _, label in TOPIC_RULES))

_written: dict[tuple, object] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """Tables several queries read are written once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = build()
    return _written[key]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that results compare across engines."""
    return df.select(*[
        F.round(c.name, digits).alias(c.name) if c.dataType == T.DoubleType() else F.col(c.name)
        for c in df.schema
    ])


# --- shared steps -----------------------------------------------------------

def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return _once(spark, d, "cleaned", lambda: staging.cleaned_reviews(reviews_raw(spark, d)))


def staged(spark: SparkSession, d: str) -> DataFrame:
    def build() -> DataFrame:
        df = cleaned(spark, d)
        rollup = write_once(stats.bank_rollup(df), "bank_rollup")
        return write_once(staging.impute(staging.final_filter(df), rollup), "staged")

    return _once(spark, d, "staged", build)


def lexicon(spark: SparkSession, d: str) -> DataFrame:
    """A lexicon over the words of ``benchmark``, weights from a hash of the word."""
    words = (
        table(spark, d, "benchmark").select(F.explode(X.words("text")).alias("term"))
        .filter(F.length("term") >= 3).distinct()
    )
    kinds = F.array(*[
        F.struct(F.lit(lang).alias("lang"), F.lit(source).alias("source"), F.lit(unit).alias("unit"))
        for lang, source, unit in (("fr", "polarity", 8.0), ("en", "polarity", 8.0), ("en", "intensity", 2.0))
    ])
    rows = words.select("term", F.explode(kinds).alias("k")).select("term", "k.*")
    digit = F.conv(F.substring(F.md5(F.concat_ws(":", "lang", "source", "term")), 1, 1), 16, 10).cast("int")
    return rows.select("lang", "source", "term", ((digit - 8) / F.col("unit")).alias("weight"))


def written_lexicon(spark: SparkSession, d: str) -> DataFrame:
    return _once(spark, d, "lexicon", lambda: write_once(lexicon(spark, d), "lexicon"))


def with_topics(df: DataFrame) -> DataFrame:
    """Stand-in topics from a hash of the text."""
    number = hash_number(F.col("final_text"), 0)
    names = F.array(*[F.lit(t) for t in TOPIC_NAMES])
    return df.withColumns({
        "topic_id": (number % len(TOPIC_NAMES)).cast("int"),
        "topic_name": F.element_at(names, (number % len(TOPIC_NAMES) + 1).cast("int")),
        "topic_confidence": (number % 40 + 60) / 100.0,
    })


def held_out() -> Column:
    return hash_number(F.col("doc_id").cast("string"), 0) % 4 == 0


def trained_language_model(spark: SparkSession, d: str) -> DataFrame:
    """The model of three quarters of the labelled documents."""
    return _once(spark, d, "language_model", lambda: language_model.fit_language_model(
        documents(spark, d).filter(~held_out())))


def enriched(spark: SparkSession, d: str) -> DataFrame:
    return _once(spark, d, "enriched", lambda: write_once(
        with_topics(enrich(staged(spark, d), lexicon(spark, d), trained_language_model(spark, d))), "enriched"
    ))


def star(spark: SparkSession, d: str) -> marts.Star:
    return _once(spark, d, "star", lambda: marts.build_star(enriched(spark, d)))


# --- text, rating, key, place and date functions ------------------------------

@query
def clean_text_basic(spark, d):
    return documents(spark, d).select("doc_id", X.clean_text_basic("text").alias("cleaned"))


@query
def clean_text_no_digits(spark, d):
    return documents(spark, d).select("doc_id", X.clean_text_no_digits("text").alias("cleaned"))


@query
def normalize_text(spark, d):
    return documents(spark, d).select("doc_id", X.normalize_text("text").alias("normalized"))


@query
def is_valid_text(spark, d):
    return documents(spark, d).select(
        "doc_id", X.is_valid_text("text").alias("valid"),
        X.is_valid_text("source", 5, allow_numbers=False).alias("valid_source"),
    )


@query
def text_metrics(spark, d):
    base = documents(spark, d).select("doc_id", "text", X.clean_text_basic("text").alias("cleaned"))
    return X.text_metrics(base, "text", "cleaned").drop("text", "cleaned")


@query
def select_text(spark, d):
    return cleaned(spark, d).select("bank_name", "branch_name", "review_date", "final_text")


@query
def text_quality(spark, d):
    q = X.text_quality("retention_percentage").alias("text_quality")
    return cleaned(spark, d).groupBy(q).agg(F.count("*").alias("review_count"))


@query
def parse_decimal_comma(spark, d):
    rating = ratings.parse_decimal_comma("bank_rating").cast("double")
    return reviews_raw(spark, d).select("doc_id", rating.alias("bank_rating"))


@query
def clamp_rating(spark, d):
    return reviews_raw(spark, d).select(
        "doc_id", ratings.clamp_rating("review_rating").alias("review_rating")
    )


@query
def review_id(spark, d):
    key = keys.review_id("bank_name", "branch_name", "review_date", "review_text")
    return reviews_raw(spark, d).select("doc_id", key.alias("id"))


@query
def surrogate_key(spark, d):
    return reviews_raw(spark, d).select(
        "doc_id", keys.surrogate_key("bank_name", "review_date").alias("row_key")
    )


@query
def city_and_region(spark, d):
    places = reviews_raw(spark, d).select("doc_id", "bank_location")
    by_name = geo.with_place(places, "bank_location")
    by_city = by_name.withColumnRenamed("region", "region_by_name")
    by_city = geo.with_place(by_city.drop("city"), "bank_location", region_from_city=True)
    return by_city.select(
        "doc_id", "city", F.col("region_by_name").alias("region"), F.col("region").alias("region_by_city")
    )


RELATIVE_FORMS = [
    "il y a {n} jours", "Il y a {n} semaines", "il y a {n} mois", "il y a {n} ans",
    "il y a une semaine", "il y a un mois", "il y a un an", "{n} jours", "un mois",
    "hier", "aujourd'hui", "il y a un jour", "Modifié il y a {n} année.", "",
]


@query
def parse_relative_date(spark, d):
    """Relative dates written into the documents' ids, read back as dates."""
    n = (F.col("doc_id") % 11 + 1).cast("string")
    forms = F.array(*[
        F.replace(F.lit(f), F.lit("{n}"), n) for f in RELATIVE_FORMS
    ])
    said = F.element_at(forms, (F.col("doc_id") % len(RELATIVE_FORMS) + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", said.alias("said")).select(
        "doc_id", "said",
        dates.parse_relative_date("said", AS_OF).alias("review_date"),
    )


# --- language and sentiment ---------------------------------------------------

@query
def language_by_indicators(spark, d):
    return documents(spark, d).select("doc_id", language.language_by_indicators("text").alias("language"))


@query
def detect_language(spark, d):
    """Routing of a model decision whose probability varies by document."""
    prob = (hash_number(F.col("text"), 0) % 100) / 100.0
    lang = language.detect_language("text", F.col("lang"), prob)
    return documents(spark, d).select("doc_id", lang.alias("language"))


@query
def language_model_accuracy(spark, d):
    """A model trained on three quarters of the labelled documents, judged on the others."""
    found = language_model.apply_language_model(
        documents(spark, d).filter(held_out()), trained_language_model(spark, d), "text")
    right = F.count_if(F.col("lang") == F.col("model_lang"))
    return found.agg(F.count("*").alias("held_out"), (right >= 0.95 * F.count("*")).alias("accurate"))


@query
def language_model_table(spark, d):
    """The model itself: weight of every trigram in every language."""
    return trained_language_model(spark, d)


@query
def language_by_model(spark, d):
    """Language of the held-out documents, model first."""
    docs = documents(spark, d).filter(held_out())
    found = language_model.apply_language_model(docs, trained_language_model(spark, d), "text")
    votes = language.detect_language("text", F.col("model_lang"), F.col("model_prob"))
    return rounded(found.select("doc_id", "model_lang", "model_prob", votes.alias("language")))


@query
def analyze_sentiment(spark, d):
    columns = ["id", "language", "sentiment", "sentiment_score"]
    return enriched(spark, d).select(*columns)


@query
def sentiment_by_lexicon_join(spark, d):
    """The same scores with the lexicon joined as a table."""
    base = language_model.add_language(staged(spark, d), model=trained_language_model(spark, d), lowered=True)
    scored = sentiment.analyze_sentiment(base, lexicon(spark, d), method="join", lowered=True)
    return scored.select("id", "language", "sentiment", "sentiment_score")


@query
def sentiment_row_route(spark, d):
    """Scores with a quarter of the terms, compiled into the row expression."""
    base = language_model.add_language(staged(spark, d), model=trained_language_model(spark, d), lowered=True)
    short = lexicon(spark, d).filter(F.substring(F.md5("term"), 1, 1) < "4")
    scored = sentiment.analyze_sentiment(base, short, method="row", lowered=True)
    return scored.select("id", "language", "sentiment", "sentiment_score")


ARABIC_TEXTS = ["خدمة ممتازة في هذا البنك", "موظف سيء وبطيء جدا", "ok", "الانتظار طويل", "أنصح الجميع بهذا الفرع", "service rapide et bon"]


def _arabic_reviews(spark: SparkSession, d: str) -> DataFrame:
    number = (hash_number(F.col("text"), 0) % (len(ARABIC_TEXTS) + 1) + 1).cast("int")
    said = F.get(F.array(*[F.lit(t) for t in ARABIC_TEXTS]), number - 1)
    ending = F.concat(F.lit(" "), (F.col("doc_id") % 10).cast("string"))
    return documents(spark, d).select("doc_id", F.concat(said, ending).alias("final_text"))


def load_arabic_classifier():
    """A stand-in classifier: the label by a word, the confidence by the last digit."""
    def classify(texts: list[str]) -> list[tuple[str, float]]:
        label = lambda t: "POSITIVE" if "ممتاز" in t else "negative" if "سيء" in t else "neutral"
        return [(label(t), int(t[-1]) / 10) for t in texts]

    return classify


@query
def sentiment_arabic(spark, d):
    """Arabic reviews scored by a classifier inside a worker, the others by the built-in lexicon."""
    return _arabic_scored(spark, d, sentiment.model_score(load_arabic_classifier))


@query
def sentiment_arabic_lexicon(spark, d):
    """The same reviews without a classifier: mean polarity of the Arabic words found."""
    return _arabic_scored(spark, d, None)


def _arabic_scored(spark: SparkSession, d: str, model) -> DataFrame:
    reviews = language_model.add_language(_arabic_reviews(spark, d))
    scored = sentiment.analyze_sentiment(reviews, default_lexicon(spark), arabic_score=model)
    return scored.select("doc_id", "language", "sentiment", "sentiment_score")


@query
def normalize_text_arabic(spark, d):
    """Cleaning that keeps Arabic letters, and French cleaning that keeps words of polarity."""
    both = documents(spark, d).join(_arabic_reviews(spark, d).withColumnRenamed("doc_id", "of"), F.col("doc_id") == F.col("of"))
    return both.select(
        "doc_id", X.normalize_text("final_text", scripts=("latin", "arabic")).alias("arabic"),
        X.normalize_text("text", languages=["fr"], keep_negation=True).alias("polar"))


@query
def classify_polarity(spark, d):
    label, score = sentiment.classify_polarity(F.col("polarity"))
    polarity = ((hash_number(F.col("text"), 1) % 20001) - 10000) / 10000.0
    base = documents(spark, d).select("doc_id", polarity.alias("polarity"))
    return base.select("doc_id", label.alias("sentiment"), score.alias("sentiment_score"))


@query
def validate_sentiment(spark, d):
    """Labels and scores of which some are taken away or turned round, by the id."""
    turn = F.conv(F.substring("id", 1, 4), 16, 10).cast("int") % 10
    planted = enriched(spark, d).withColumns({
        "sentiment": F.when(turn == 1, None).when(turn == 2, "positive").when(turn == 3, "negative").otherwise(F.col("sentiment")),
        "sentiment_score": F.when(turn == 4, None).otherwise(F.col("sentiment_score")),
    })
    return quality.validate_sentiment(planted)


@query
def language_profile(spark, d):
    return quality.value_profile(enriched(spark, d), "language")


@query
def sentiment_profile(spark, d):
    return quality.value_profile(enriched(spark, d), "sentiment")


@query
def topic_profile(spark, d):
    return quality.value_profile(enriched(spark, d), "topic_name")


@query
def column_profile(spark, d):
    return rounded(quality.column_profile(
        enriched(spark, d), "final_text", TF.preprocess_for_topics("final_text"), "topic_confidence"
    ))


# --- cleaning -----------------------------------------------------------------

@query
def raw_reviews(spark, d):
    return reviews_raw(spark, d)


@query
def keep_informative(spark, d):
    blank = F.when(F.col("doc_id") % 3 != 0, F.col("review_text"))
    kept = staging.keep_informative(reviews_raw(spark, d).withColumn("review_text", blank))
    return kept.select("doc_id", "review_rating", F.length("review_text").alias("text_length"))


@query
def dedup_reviews(spark, d):
    return dedup.dedup_reviews(staging.early_filter(reviews_raw(spark, d))).drop("doc_id")


@query
def bank_statistics(spark, d):
    return rounded(stats.bank_statistics(cleaned(spark, d)))


@query
def global_stats(spark, d):
    return rounded(stats.global_stats(cleaned(spark, d)))


@query
def impute_rating(spark, d):
    return staged(spark, d).groupBy("bank_name", "rating_source", "review_rating").agg(
        F.count("*").alias("review_count")
    )


@query
def impute_bank_rating(spark, d):
    return staged(spark, d).groupBy("bank_name", "bank_rating").agg(F.count("*").alias("review_count"))


@query
def staging_reviews_cleaned(spark, d):
    """The whole cleaning chain from raw reviews."""
    return staging.staging(reviews_raw(spark, d), processed_at=False)


@query
def average_rating_per_bank(spark, d):
    """Reviews and average rating per bank after cleaning and imputation."""
    out = staging.staging(reviews_raw(spark, d), processed_at=False)
    tenths = F.col("review_rating").cast("decimal(4,1)")
    return rounded(out.groupBy("bank_name").agg(
        F.count("*").alias("review_count"),
        (F.sum(tenths).cast("double") / F.count("*")).alias("avg_rating"),
    ))


def _thin_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews of which a bank in three has no ratings, one in four only two, and a part are mostly signs."""
    raw = reviews_raw(spark, d)
    bank = F.regexp_extract("bank_name", "[0-9]+", 0).try_cast("int")
    few = (bank % 4 == 1) & (F.col("doc_id") % 50 != 0)
    signs = F.concat(F.substring("review_text", 1, 40), F.repeat(F.lit(" 12.34;"), 40))
    return raw.withColumns({
        "review_rating": F.when((bank % 3 == 0) | few, None).otherwise(F.col("review_rating")),
        "bank_rating": F.when(bank % 3 == 0, None).otherwise(F.col("bank_rating")),
        "review_text": F.when(F.col("doc_id") % 9 == 0, signs).otherwise(F.col("review_text")),
    })


@query
def impute_global(spark, d):
    """Cleaning of reviews whose banks lack ratings: global averages and low text quality occur."""
    out = staging.staging(_thin_reviews(spark, d), processed_at=False)
    return out.groupBy("rating_source", "review_rating", "bank_rating", "text_quality").agg(F.count("*").alias("review_count"))


@query
def impute_default(spark, d):
    """Cleaning of reviews without any rating: the defaults."""
    bare = reviews_raw(spark, d).withColumns({c: F.lit(None).cast(t) for c, t in (("review_rating", "int"), ("bank_rating", "string"))})
    out = staging.staging(bare, processed_at=False)
    return out.groupBy("rating_source", "review_rating", "bank_rating").agg(F.count("*").alias("review_count"))


@query
def dq_not_null(spark, d):
    """Nulls in raw reviews."""
    return quality.dq_not_null(reviews_raw(spark, d), ["bank_name", "review_date", "review_rating", "review_text"])


@query
def dq_unique(spark, d):
    """Branches with more than one raw review."""
    return quality.dq_unique(reviews_raw(spark, d), "branch_name")


# --- collection ----------------------------------------------------------------

@query
def search_grid(spark, d):
    cities = reviews_raw(spark, d).select(geo.raw_city("bank_location").alias("city")).distinct()
    return search.search_grid(cities)


@query
def top_k_per_group(spark, d):
    """Two longest documents of every source and language."""
    order = [F.col("n_chars").desc(), F.col("doc_id")]
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    return dedup.top_k_per_group(docs, ["source", "lang"], order, 2, "place")


@query
def cap_links(spark, d):
    """First five links of every search, repeats removed."""
    links = table(spark, d, "events").select(
        "user_id", F.col("event_id").alias("position"), F.col("event_type").alias("url")
    )
    return dedup.cap_links(links, ["user_id"], "position", "url", 5)


@query
def read_reviews(spark, d):
    """Reviews written as JSON Lines and read back: two lines of three are broken, a line of seven is an array."""
    return _landed(spark, d)[0].select(*REVIEW.fieldNames())


@query
def rejected_records(spark, d):
    """What the reader left out, by the kind of fault."""
    kind = F.when(F.col("record").endswith('"cut'), "cut").when(F.contains("record", F.lit('"many"')), "type").otherwise("other")
    return _landed(spark, d)[1].groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def _landed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    def build():
        folder, rejected = new_folder(spark, "landing"), new_folder(spark, "rejected")
        raw = reviews_raw(spark, d)
        whole = F.to_json(F.struct(*REVIEW.fieldNames()))
        typed = F.to_json(F.struct(
            F.lit("many").alias("review_rating"), *[c for c in REVIEW.fieldNames() if c != "review_rating"]))
        line = (
            F.when(F.col("doc_id") % 10 == 0, F.concat(F.substring(whole, 1, 25), F.lit('"cut')))
            .when(F.col("doc_id") % 10 == 1, typed)
            .when(F.col("doc_id") % 7 == 2, F.concat(F.lit("["), whole, F.lit(","), whole, F.lit("]"))).otherwise(whole))
        raw.select(line.alias("value")).write.text(folder)
        good = write_once(tables.read_reviews(spark, folder, rejected=rejected), "landed")
        return good, tables.read_rejected(spark, rejected)

    return _once(spark, d, "landed", build)


@query
def replace_partition(spark, d):
    """Cleaned reviews by rating source; the rows of one source are replaced, all others stay."""
    folder = new_folder(spark, "by_source")
    rows = staged(spark, d).select("id", "bank_name", "review_date", "review_rating", "rating_source")
    tables.write_folder(rows, folder, ["rating_source"], ["bank_name", "review_date"])
    better = rows.filter("rating_source = 'BANK_AVERAGE'").withColumn("review_rating", F.lit(5.0))
    tables.write_folder(better, folder, ["rating_source"], ["bank_name", "review_date"], only_these=True)
    return spark.read.schema(rows.schema).parquet(folder)


@query
def partition_pruning(spark, d):
    """One row: a filter on the partition column reads fewer files than the folder has, and all its rows."""
    folder = new_folder(spark, "by_source")
    rows = staged(spark, d).select("id", "bank_name", "review_date", "rating_source")
    tables.write_folder(rows, folder, ["rating_source"], ["bank_name"])
    back = spark.read.schema(rows.schema).parquet(folder)
    one = back.filter("rating_source = 'BANK_AVERAGE'")
    return one.agg(F.count("*").alias("rows_of_source")).select(
        "rows_of_source", F.lit(tables.files_scanned(one) < tables.files_scanned(back)).alias("fewer_files"))


@query
def sorted_output(spark, d):
    """Cleaned reviews in presentation order as totally ordered files: nothing out of order in or between them."""
    folder = new_folder(spark, "sorted")
    rows = staged(spark, d)
    tables.write_sorted(rows, folder, staging.presentation_order(rows))
    rated = F.when(F.col("review_rating_clean").isNotNull(), 1).otherwise(2)
    key = F.struct(rated, -F.col("retention_percentage"), -F.unix_date("review_date"), "bank_name")
    files = tables.file_order(spark, folder, key)
    return files.agg(F.sum("rows").alias("rows"), F.sum("inversions").cast("bigint").alias("inversions"))


@query
def append_batches(spark, d):
    raw = reviews_raw(spark, d)
    first = raw.filter(F.col("review_date") < "1998-01-01")
    second = raw.filter(~(F.col("review_date") < "1998-01-01") | F.col("review_date").isNull())
    return tables.append_batches(first, second)


TEST_SELECTORS = page_source.Selectors(
    name=("h1",), address=("title",), rating=("div.ad",), review=("nav li", "article"),
    date=("b",), text=("li a", "article p"), star=("article p",),
)


def _escaped(c: str) -> Column:
    out = F.col(c)
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def review_pages(spark: SparkSession, d: str) -> DataFrame:
    """A map page for every raw review that has a bank, found under one of the grid's addresses."""
    raw = reviews_raw(spark, d).filter("bank_name IS NOT NULL")
    number = (F.col("doc_id") % len(SEARCH_BANKS) + 1).cast("int")
    searched = F.element_at(F.array(*[F.lit(b) for b in SEARCH_BANKS]), number)
    said = F.concat_ws(" ", searched, F.lit("agence"), geo.raw_city("bank_location"), F.lit("Maroc"))
    url = F.concat(F.lit(search.SEARCH_URL), F.replace(said, F.lit(" "), F.lit("+")))
    stars = F.repeat(F.lit("<span class='elGi1d'></span>"), F.greatest("review_rating", F.lit(0)))
    block = lambda text, date: F.concat(
        F.lit("<div class='jftiEf fontBodyMedium'><span class='rsqaWe'>"), date, F.lit("</span>"), stars,
        F.lit("<span class='wiI7pd'>"), text, F.lit("</span></div>"))
    # a name on two pages of three; a second review without text, with the stars alone
    name = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("<h1>"), _escaped("bank_name"), F.lit("</h1>"))).otherwise("")
    rating = F.when(F.col("bank_rating").isNotNull(), F.concat(
        F.lit("<div class='F7nice'><span><span>"), F.col("bank_rating"), F.lit("</span></span></div>"))).otherwise("")
    days = F.concat(F.lit("il y a "), (F.col("doc_id") % 11 + 1).cast("string"), F.lit(" jours"))
    html = F.concat(
        F.lit("<html><body>"), name, rating, F.lit("<div data-item-id='address'>"), _escaped("bank_location"), F.lit("</div>"),
        block(_escaped("review_text"), days), block(F.lit(""), F.lit("hier")), F.lit("</body></html>"))
    return raw.select(F.col("doc_id").alias("page_id"), url.alias("url"), html.alias("html"))


@query
def pages_to_raw_reviews(spark, d):
    """Pages found by the grid's searches, read back and joined to their search by its address."""
    cities = reviews_raw(spark, d).select(geo.raw_city("bank_location").alias("city")).distinct()
    grid = search.search_grid(cities).select(
        F.col("search_url").alias("url"), F.col("city").alias("town"), F.col("bank_name").alias("searched"))
    found = page_source.pages_to_reviews(review_pages(spark, d))
    found = join_unique(found, grid, ["url"], "inner")
    return page_source.page_reviews_to_raw(found, F.col("searched"), F.col("town"), AS_OF)


@query
def pages_to_reviews(spark, d):
    return page_source.pages_to_reviews(table(spark, d, "pages"), TEST_SELECTORS)


# --- topics ---------------------------------------------------------------------

def _corpus(spark, d):
    docs = documents(spark, d).select("doc_id", "source", F.col("text").alias("final_text"))
    return topics.topic_terms(topics.prepare_corpus(docs))


@query
def preprocess_for_topics(spark, d):
    docs = documents(spark, d)
    tokens = TF.preprocess_for_topics("text")
    return docs.select("doc_id", TF.processed_text(tokens).alias("processed_text"))


@query
def topic_corpus(spark, d):
    """Terms per review of the corpus, words and bigrams."""
    return _corpus(spark, d).select(
        "doc_id", F.size("tokens").alias("token_count"), F.size("terms").alias("term_count"),
        F.md5(F.array_join("terms", "|")).alias("terms_md5"),
    )


@query
def topic_vocabulary(spark, d):
    """The vectoriser's vocabulary over the whole corpus."""
    corpus = write_once(_corpus(spark, d).select("terms"), "topic_corpus")
    return topics.topic_vocabulary(corpus)


@query
def vectorise(spark, d):
    """Sparse vectors of the whole corpus over its vocabulary, one row per entry."""
    corpus = write_once(_corpus(spark, d).select("doc_id", "terms"), "topic_corpus")
    vocabulary = sorted(r["term"] for r in topics.topic_vocabulary(corpus).select("term").collect())
    return topics.vector_rows(topics.vectorise(corpus, vocabulary).select("doc_id", "features"), vocabulary)


@query
def lemmatise(spark, d):
    """Tokens of the corpus replaced by the first four letters of half of the words; every document twice.

    The dictionary comes from the words of ``benchmark`` and of the corpus, with two lemmas for some.
    """
    docs = documents(spark, d).select("doc_id", F.col("text").alias("final_text"))
    corpus = topics.prepare_corpus(docs)
    words = write_once(corpus.select(F.explode("tokens").alias("token")).distinct(), "corpus_words")
    half = words.filter(hash_number(F.col("token"), 0) % 2 == 0)
    lemmas = half.select("token", F.substring("token", 1, 4).alias("lemma")).union(
        half.filter(hash_number(F.col("token"), 1) % 3 == 0).select("token", F.lit("zzz")))
    twice = corpus.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    found = topics.lemmatise(twice, lemmas)
    return found.select("doc_id", "copy", F.size("tokens").alias("token_count"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


CURVE = {"low": 300, "spread": 400}


@query
def pick_topic_counts(spark, d):
    """The rule that picks a topic count, on a curve of perplexities per document made from hashes."""
    counts = F.explode(F.sequence(F.lit(topics.MIN_TOPICS), F.lit(topics.MAX_TOPICS))).alias("topic_count")
    curve = documents(spark, d).select("doc_id", counts)
    said = F.concat_ws(":", "doc_id", "topic_count")
    value = (hash_number(said, 0) % CURVE["spread"] + CURVE["low"]).cast("double")
    curve = curve.withColumn("perplexity", F.when(hash_number(said, 1) % 7 != 0, value))
    return topics.pick_topic_counts(curve, ["doc_id"])


@query
def choose_topic_count(spark, d):
    """One row: the search that stops early picks what the whole search over all counts picks."""
    corpus = write_once(_corpus(spark, d).select(topics.WORDS), "topic_corpus")
    vectors = topics.prepared(corpus)
    whole = topics.choose_topic_count(vectors, iterations=5, whole=True)
    early = topics.choose_topic_count(vectors, iterations=5)
    return corpus.agg(F.count("*").alias("documents")).select(
        "documents", F.lit(early == whole).alias("same_choice"),
        F.lit(topics.MIN_TOPICS <= early <= topics.MAX_TOPICS).alias("in_range"))


@query
def label_topics(spark, d):
    """Labels of pseudo-topics: the ten most frequent words of every source."""
    words = (
        _corpus(spark, d).select("source", F.explode(TF.model_words("tokens")).alias("word"))
        .groupBy("source", "word").agg(F.count("*").alias("n"))
    )
    top = dedup.top_k_per_group(words, ["source"], [F.col("n").desc(), F.col("word")], 10, "rank")
    ranked = top.select(F.col("source").alias("topic_id"), (F.col("rank") - 1).alias("rank"), "word")
    return topics.label_topics(ranked)


@query
def assign_topics(spark, d):
    """LDA topics of all cleaned reviews: search for the topic count, then the whole fit."""
    found = topics.extract_topics(staged(spark, d))
    return found.select("id", "topic_id", "topic_name", "topic_confidence")


@query
def topic_assignment_checks(spark, d):
    """One row about the topics of all cleaned reviews; everything but the sizes must be 0."""
    found = _once(spark, d, "topic_assignments", lambda: write_once(assign_topics(spark, d), "topic_assignments"))
    inside, share = F.col("topic_id") >= 0, F.col("topic_confidence")
    in_range = F.col("topic_id").between(-1, topics.MAX_TOPICS - 1)
    likely = F.when(inside, share.between(1 / topics.MAX_TOPICS, 1)).otherwise(share == 0)
    return found.agg(
        F.count("*").alias("reviews"), F.count_if(~inside).alias("unclassified"),
        F.count_if(~F.coalesce(in_range, F.lit(False))).alias("ids_out_of_range"),
        F.count_if(~F.coalesce(likely, F.lit(False))).alias("confidences_out_of_range"),
        F.count_if(inside.eqNullSafe(F.col("topic_name") == "Unclassified")).alias("names_unlike_ids"),
        (F.countDistinct("topic_id", "topic_name") - F.countDistinct("topic_id")).alias("topics_of_several_names"),
    )


@query
def merge_topics(spark, d):
    """Reviews with topics assigned to a part of them."""
    reviews = staged(spark, d).select("id", "bank_name")
    assigned = enriched(spark, d).filter("language = 'fr'").select(
        "id", "topic_id", "topic_name", "topic_confidence"
    )
    return topics.merge_topics(reviews, assigned)


@query
def merge_repeated_topics(spark, d):
    """Ids that occur several times on both sides: every review once, with the first of its topics."""
    reviews = staged(spark, d).select(F.substring("id", 1, 2).alias("id"), "bank_name")
    assigned = enriched(spark, d).filter("language = 'fr'").select(
        F.substring("id", 1, 2).alias("id"), "topic_id", "topic_name", "topic_confidence")
    merged = topics.merge_topics(reviews, assigned)
    return merged.groupBy(*merged.columns).agg(F.count("*").alias("n"))


# --- star schema and reports ------------------------------------------------------

for _dim in ("bank", "branch", "date", "location", "sentiment", "topic"):
    def _make(name):
        return lambda spark, d: getattr(marts, f"dim_{name}")(enriched(spark, d))
    QUERIES[f"dim_{_dim}"] = _make(_dim)


@query
def fact_reviews(spark, d):
    return marts.fact_reviews(enriched(spark, d))


for _report in ("branch_performance", "sentiment_trends", "topic_analysis", "customer_experience"):
    def _make_report(name, grain_safe):
        return lambda spark, d: rounded(getattr(reports, name)(star(spark, d), grain_safe))
    QUERIES[_report] = _make_report(_report, True)
    QUERIES[f"{_report}_as_joined"] = _make_report(_report, False)


for _report in (
    "reviews_by_sentiment_over_time", "sentiment_by_topic", "volume_by_topic_sentiment",
    "branch_ranking_in_bank", "topic_share",
):
    def _make_simple(name):
        return lambda spark, d: rounded(getattr(reports, name)(star(spark, d)))
    QUERIES[_report] = _make_simple(_report)


@query
def sentiment_by_bank(spark, d):
    return rounded(reports.sentiment_by_bank(star(spark, d), "2000-06-21"))


# --- alerts and streams --------------------------------------------------------------

ALERT = {"window": "1 day", "min_share": 0.2, "min_count": 10}


@query
def negative_spike_alert(spark, d):
    events = table(spark, d, "events").select("ts", "event_type")
    negative = F.col("event_type") == "error"
    return rounded(alerts.negative_spike_alert(events, "ts", negative, **ALERT))


@query
def negative_spike_alert_stream(spark, d):
    """The alert over a stream of the same events; the last update of a window counts."""
    schema = table(spark, d, "events").schema
    events = incremental.read_review_stream(spark, d, schema, "parquet", glob="events.parquet")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    found = incremental.alert_stream(events, "ts", F.col("event_type") == "error", **ALERT)
    folder = new_folder(spark, "alerts")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{folder}/batch_id={batch_id}"
        )

    stream = incremental.refresh_stream(found, save, new_folder(spark, "alerts_state"), mode="update")
    stream.awaitTermination()
    rows = spark.read.schema(found.schema.add("batch_id", T.IntegerType())).parquet(f"{folder}/*")
    last = dedup.top_k_per_group(rows, ["window_start"], [F.col("batch_id").desc()], 1)
    return rounded(last.drop("batch_id").withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")
    }))


def review_store(spark: SparkSession, d: str) -> str:
    """Reviews of three files, the newest first, taken in one by one; repeated and better copies come later."""
    def build() -> str:
        raw = reviews_raw(spark, d)
        inbox, store, state = (new_folder(spark, x) for x in ("inbox", "incremental", "incremental_state"))
        parts = [
            F.col("review_date") >= "1999-06-01",
            (F.col("review_date") < "1999-06-01") & (F.col("review_date") >= "1997-01-01"),
            (F.col("review_date") < "1997-01-01") | F.col("review_date").isNull(),
        ]
        for number, part in enumerate(parts):
            own = F.when(F.col("doc_id") % 2 == 0, part).otherwise(F.col("doc_id") % 3 == number)
            again = F.crc32(F.col("review_text").cast("binary")) % 7 == number
            raw.filter(own | again).write.parquet(f"{inbox}/{number}")
            stream = incremental.read_review_stream(spark, f"{inbox}/*", raw.schema, "parquet")
            live.live_reports(
                stream, store, state, classify=with_topics, lexicon=written_lexicon(spark, d),
                language_model=trained_language_model(spark, d)).awaitTermination()
        return store

    return _once(spark, d, "review_store", build)


@query
def incremental_reviews(spark, d):
    """Reviews of three files taken in one by one: the batch result."""
    return incremental.stored_reviews(spark, review_store(spark, d), reviews_raw(spark, d).schema).drop("doc_id")


def live_star(spark: SparkSession, d: str) -> marts.Star:
    return _once(spark, d, "live_star", lambda: live.live_star(spark, review_store(spark, d)))


# Every report from the counts that the three files left: the batch report.
for _report in ("branch_performance", "sentiment_trends", "topic_analysis", "customer_experience"):
    def _make_live(name):
        return lambda spark, d: rounded(getattr(reports, name)(live_star(spark, d)))
    QUERIES[f"{_report}_live"] = _make_live(_report)
for _report in (
    "reviews_by_sentiment_over_time", "sentiment_by_topic", "volume_by_topic_sentiment",
    "branch_ranking_in_bank", "topic_share",
):
    QUERIES[f"{_report}_live"] = _make_live(_report)


@query
def sentiment_by_bank_live(spark, d):
    return rounded(reports.sentiment_by_bank(live_star(spark, d), "2000-06-21"))
