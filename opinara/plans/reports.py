"""Reports over the star schema.

Every report first reduces the fact to one row per combination of the keys it
needs (map-side combine, so hot banks or topics do not matter) and only then
meets the dimensions.

Some dimension keys are coarser than the dimension rows (a location key covers
many addresses, a topic key many confidences, a branch key may belong to several
banks).  A plain join repeats a review once per such row.  With
``grain_safe=True`` every review counts once; with ``grain_safe=False`` the
plain-join figures come out, by carrying the number of dimension rows as a
multiplicity instead of producing the repeated rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.keyed_join import join_small
from ..operators.ranking import rank_by
from ..sources.scratch import write_once
from .marts import Star

RATING = "decimal(12,4)"
SCORE = "decimal(9,6)"
# --- fixed values: weights of the branch score, lowest promoter rating -----
RATING_WEIGHT = 0.6
POSITIVE_WEIGHT = 0.4
PROMOTER_FROM = 4


Dim = tuple[DataFrame, int]  # one row per key, and an upper bound of the row count


def _one_per_key(dim: DataFrame, key: str, attributes: list[str], grain_safe: bool) -> Dim:
    """One row per key and attributes, with its multiplicity ``__m_<key>``.

    The row count of the written dimension table (read from its footers) bounds
    the size.
    """
    rows = dim.groupBy(key, *attributes).agg(F.count("*").alias(f"__m_{key}"))
    if grain_safe:
        rows = rows.withColumn(f"__m_{key}", F.lit(1).cast("bigint"))
    return rows, dim.count()


def _join_dims(reduced: DataFrame, dims: list[Dim]) -> DataFrame:
    """Join reduced fact rows with dimensions; ``w`` is how often each row repeats."""
    keys = []
    for dim, size in dims:
        key = dim.columns[0]
        keys.append(f"__m_{key}")
        reduced = join_small(reduced, dim, [key], rows=size)
    weight = reduce(lambda a, b: a * b, [F.col(k) for k in keys])
    return reduced.withColumn("w", weight).drop(*keys)


def _ratio(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count.cast("double"))


def _copies(fact: DataFrame) -> Column | None:
    """How many reviews a row of the fact stands for, when rows are counted reviews."""
    return F.col("copies") if "copies" in fact.columns else None


def _count(fact: DataFrame, when: Column | None = None) -> Column:
    copies = _copies(fact)
    if copies is None:
        return F.count("*") if when is None else F.count_if(when)
    return F.sum(copies if when is None else F.when(when, copies).otherwise(0))


def _total(fact: DataFrame, value: Column) -> Column:
    copies = _copies(fact)
    return F.sum(value if copies is None else (value * copies).cast("decimal(24,4)"))


def _rated(star_fact: DataFrame, keys: list[str]) -> DataFrame:
    rating = F.col("review_rating")
    return star_fact.groupBy(*keys).agg(
        _count(star_fact).alias("n"),
        _total(star_fact, rating.cast(RATING)).alias("rating_sum"),
        _count(star_fact, rating.isNotNull()).alias("rating_n"),
        _count(star_fact, rating >= PROMOTER_FROM).alias("promoters"),
    )


def _counted(star_fact: DataFrame, keys: list[str]) -> DataFrame:
    return star_fact.groupBy(*keys).agg(_count(star_fact).alias("n"))


def _bank(star: Star, grain_safe: bool) -> Dim:
    return _one_per_key(star.bank, "bank_id", ["bank_name"], grain_safe)


def _branch(star: Star, grain_safe: bool) -> Dim:
    return _one_per_key(star.branch, "branch_id", ["branch_name"], grain_safe)


def _location(star: Star, grain_safe: bool) -> Dim:
    return _one_per_key(star.location, "location_id", ["city", "region"], grain_safe)


def _sentiment(star: Star, grain_safe: bool) -> Dim:
    return _one_per_key(star.sentiment, "sentiment_id", ["sentiment", "sentiment_score"], grain_safe)


def _topic(star: Star, grain_safe: bool) -> Dim:
    return _one_per_key(star.topic, "topic_id", ["topic_name"], grain_safe)


def _date(star: Star, grain_safe: bool) -> Dim:
    return _one_per_key(star.date, "date_id", ["full_date", "day", "month", "year"], grain_safe)


def _n() -> Column:
    return F.col("n") * F.col("w")


def _avg_score() -> Column:
    score = F.col("sentiment_score").cast(SCORE)
    return _ratio(F.sum(score * _n()), F.sum(F.when(score.isNotNull(), _n())))


def _positive_pct() -> Column:
    return _ratio(F.sum(F.when(F.col("sentiment") == "positive", _n()).otherwise(0)), F.sum(_n())) * 100


def branch_metrics(star: Star, grain_safe: bool = True) -> DataFrame:
    """Review count, average rating and shares per branch and city."""
    reduced = _rated(star.fact, ["bank_id", "branch_id", "location_id", "sentiment_id"])
    joined = _join_dims(reduced, [
        _sentiment(star, grain_safe), _bank(star, grain_safe),
        _branch(star, grain_safe), _location(star, grain_safe),
    ])
    w = F.col("w")
    return joined.groupBy("bank_name", "branch_name", "city", "region").agg(
        F.sum(_n()).alias("total_reviews"),
        _ratio(F.sum(F.col("rating_sum") * w), F.sum(F.col("rating_n") * w)).alias("avg_rating"),
        _avg_score().alias("avg_sentiment"),
        _positive_pct().alias("positive_percentage"),
        (_ratio(F.sum(F.col("promoters") * w), F.sum(_n())) * 100).alias("promoter_percentage"),
    )


def branch_performance(star: Star, grain_safe: bool = True) -> DataFrame:
    """Branch metrics with a performance score, its rank and the rank in the region."""
    score = F.col("avg_rating") * RATING_WEIGHT + F.col("positive_percentage") * POSITIVE_WEIGHT
    scored = branch_metrics(star, grain_safe).withColumn("performance_score", score)
    scored = write_once(scored, "branch_scores")
    ranked = rank_by(scored, "performance_score", "overall_rank")
    return rank_by(ranked, "avg_rating", "regional_rank", ["region"])


def sentiment_trends(star: Star, grain_safe: bool = True) -> DataFrame:
    """Reviews per bank, branch, day and sentiment."""
    reduced = _counted(star.fact, ["bank_id", "branch_id", "date_id", "sentiment_id"])
    joined = _join_dims(reduced, [
        _sentiment(star, grain_safe), _bank(star, grain_safe),
        _date(star, grain_safe), _branch(star, grain_safe),
    ])
    return joined.groupBy(
        "bank_name", "branch_name", F.col("full_date").alias("review_date"),
        F.col("month").alias("review_month"), F.col("year").alias("review_year"), "sentiment",
    ).agg(
        F.sum(_n()).alias("review_count"),
        _avg_score().alias("avg_sentiment_score"),
        _positive_pct().alias("positive_percentage"),
    )


def topic_analysis(star: Star, grain_safe: bool = True) -> DataFrame:
    """Reviews per topic and sentiment, share within the topic, ranks over all rows."""
    reduced = _counted(star.fact, ["topic_id", "sentiment_id"])
    joined = _join_dims(reduced, [_sentiment(star, grain_safe), _topic(star, grain_safe)])
    stats = joined.groupBy("topic_name", "sentiment").agg(
        F.sum(_n()).alias("occurrence_count"), _avg_score().alias("avg_sentiment")
    )
    # One row per topic and sentiment: a topic has at most four rows here.
    in_topic = F.sum("occurrence_count").over(W.partitionBy("topic_name"))
    stats = stats.withColumn(
        "sentiment_distribution", _ratio(F.col("occurrence_count"), in_topic) * 100
    )
    ranked = rank_by(write_once(stats, "topic_stats"), "occurrence_count", "__rank")
    for label in ("positive", "negative"):
        ranked = ranked.withColumn(f"{label}_rank", F.when(F.col("sentiment") == label, F.col("__rank")))
    return ranked.drop("__rank")


def customer_experience(star: Star, grain_safe: bool = True) -> DataFrame:
    """Average rating, critical and positive topics and rating-sentiment correlation.

    Groups by day of month and month, across years.  The correlation comes from
    integer moments (thousandths), so constant input is recognised exactly and
    gives null.
    """
    r = F.round(F.col("review_rating") * 1000).cast("bigint")
    reduced = star.fact.groupBy("date_id", "topic_id", "sentiment_id").agg(
        _total(star.fact, F.col("review_rating").cast(RATING)).alias("rating_sum"),
        _count(star.fact, F.col("review_rating").isNotNull()).alias("n"),
        _total(star.fact, r).cast("bigint").alias("sx"), _total(star.fact, r * r).cast("bigint").alias("sxx"),
    )
    joined = _join_dims(reduced, [
        _sentiment(star, grain_safe), _date(star, grain_safe), _topic(star, grain_safe),
    ])
    y = F.round(F.col("sentiment_score") * 1000).cast("bigint")
    w, scored = F.col("w"), F.col("sentiment_score").isNotNull()

    def total(c: Column) -> Column:
        return F.sum(F.when(scored, c * w).cast("decimal(28,0)"))

    def topics(label: str) -> Column:
        name = F.when(F.col("sentiment") == label, F.col("topic_name"))
        return F.array_sort(F.collect_set(name))

    sums = joined.groupBy("day", "month").agg(
        _ratio(F.sum(F.col("rating_sum") * w), F.sum(_n())).alias("avg_rating"),
        topics("negative").alias("critical"), topics("positive").alias("positive"),
        total(F.col("n")).alias("c"), total(F.col("sx")).alias("sx"),
        total(F.col("sxx")).alias("sxx"), total(F.col("n") * y).alias("sy"),
        total(F.col("n") * y * y).alias("syy"), total(F.col("sx") * y).alias("sxy"),
    )
    c, sx, sy = F.col("c"), F.col("sx"), F.col("sy")
    var_x = c * F.col("sxx") - sx * sx
    var_y = c * F.col("syy") - sy * sy
    cov = (c * F.col("sxy") - sx * sy).cast("double")
    spread = F.sqrt(var_x.cast("double")) * F.sqrt(var_y.cast("double"))

    def listed(name: str) -> Column:
        return F.when(F.size(name) > 0, F.array_join(name, ", "))

    return sums.select(
        "day", "month", "avg_rating",
        listed("critical").alias("critical_topics"), listed("positive").alias("positive_topics"),
        F.try_divide(cov, spread).alias("rating_sentiment_correlation"),
    )


def _simple(star: Star, names: list[str], group: list[str]) -> DataFrame:
    """Review counts by attributes of dimensions, every review counted once."""
    dims = {
        "bank": _bank, "branch": _branch, "date": _date, "sentiment": _sentiment, "topic": _topic,
    }
    reduced = _counted(star.fact, [f"{n}_id" for n in names])
    joined = _join_dims(reduced, [dims[n](star, True) for n in names])
    return joined.groupBy(*group).agg(F.sum("n").alias("review_count"))


def reviews_by_sentiment_over_time(star: Star) -> DataFrame:
    return _simple(star, ["date", "sentiment"], ["year", "sentiment"])


def sentiment_by_bank(star: Star, as_of: str | None = None) -> DataFrame:
    """Reviews and share per bank and sentiment, up to a day."""
    dated = star
    if as_of is not None:
        days = star.date.filter(F.col("full_date") <= F.lit(as_of).cast("date"))
        dated = Star(**{**star.__dict__, "date": days})
    counts = _simple(dated, ["date", "bank", "sentiment"], ["bank_name", "sentiment"])
    # One row per bank and sentiment.
    in_bank = F.sum("review_count").over(W.partitionBy("bank_name"))
    return counts.withColumn("share_pct", _ratio(F.col("review_count"), in_bank) * 100)


def sentiment_by_topic(star: Star) -> DataFrame:
    """Share of each sentiment within every topic."""
    counts = _simple(star, ["topic", "sentiment"], ["topic_name", "sentiment"])
    in_topic = F.sum("review_count").over(W.partitionBy("topic_name"))
    return counts.withColumn("share_pct", _ratio(F.col("review_count"), in_topic) * 100)


def volume_by_topic_sentiment(star: Star) -> DataFrame:
    """One row per topic with a review count for each sentiment."""
    counts = _simple(star, ["topic", "sentiment"], ["topic_name", "sentiment"])
    labels = ["positive", "neutral", "negative", "unknown"]
    return (
        counts.groupBy("topic_name").pivot("sentiment", labels)
        .agg(F.sum("review_count")).fillna(0, labels)
    )


def branch_ranking_in_bank(star: Star) -> DataFrame:
    """Branches of every bank ranked by their share of positive reviews."""
    counts = _simple(
        star, ["bank", "branch", "sentiment"], ["bank_name", "branch_name", "sentiment"]
    )
    shares = counts.groupBy("bank_name", "branch_name").agg(
        F.sum("review_count").alias("review_count"),
        (_ratio(
            F.sum(F.when(F.col("sentiment") == "positive", F.col("review_count")).otherwise(0)),
            F.sum("review_count"),
        ) * 100).alias("positive_percentage"),
    )
    return rank_by(write_once(shares, "branch_shares"), "positive_percentage", "bank_rank", ["bank_name"])


def topic_share(star: Star) -> DataFrame:
    """Reviews per topic and their share of all reviews."""
    counts = _simple(star, ["topic"], ["topic_name"])
    total = counts.agg(F.sum("review_count").alias("total"))
    return counts.withColumn("share_pct", _ratio(F.col("review_count"), total.scalar()) * 100)
