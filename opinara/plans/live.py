"""Reports kept up to date from new files, without reading stored reviews again.

Every accepted review is reduced to its facts (bank, branch, address, day, ratings, label,
score, topic).  The store keeps counts per combination of facts as signed changes, one small
table per batch; bank and global averages, imputed ratings, dimensions and all ten reports
follow from the summed counts alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import ratings as R
from ..operators.keyed_join import join_unique
from ..sources.scratch import write_once
from ..sources.tables import write_replace
from ..streaming.incremental import combinations, incremental_reviews
from . import reports
from .enrichment import enrich
from .marts import Star, star_of_combinations
from .staging import early_filter, is_final, normalise, text_selection
from .warehouse import REPORTS, SIMPLE_REPORTS

FACTS = [
    "bank_name", "branch_name", "bank_location", "review_date", "review_rating_clean", "final",
    "sentiment", "sentiment_score", "topic_name", "topic_confidence",
]


def review_facts(
    reviews: DataFrame, classify: Callable[[DataFrame], DataFrame], lexicon: DataFrame | None = None,
    language_model: DataFrame | None = None, arabic_score=None,
) -> DataFrame:
    """``key_hash`` and facts of accepted raw reviews; those without usable text have none.

    ``classify`` adds ``topic_name`` and ``topic_confidence`` from ``final_text``.  Reviews
    that only count for bank averages (``final`` false) keep bank and rating.
    """
    cleaned = text_selection(normalise(reviews, keep=("key_hash",))).withColumn("final", F.coalesce(is_final(), F.lit(False)))
    found = classify(enrich(cleaned, lexicon, language_model, arabic_score))
    day = F.col("review_date").try_cast("date").alias("review_date")
    known = {"review_date": day}
    always = ("bank_name", "review_rating_clean", "final")
    return found.select("key_hash", *[
        F.col(c) if c in always else F.when(F.col("final"), known.get(c, F.col(c))).alias(c) for c in FACTS])


def counted_reviews(facts: DataFrame) -> DataFrame:
    """Counted final reviews with imputed ``review_rating``, from summed combinations."""
    rated = F.col("review_rating_clean").isNotNull()
    exact = F.col("review_rating_clean").cast("decimal(3,1)")
    sums = write_once(facts.groupBy("bank_name").agg(
        F.sum("n").alias("n"), F.sum(F.when(rated, F.col("n")).otherwise(0)).alias("rating_count"),
        F.sum((exact * F.col("n")).cast("decimal(24,1)")).alias("rating_sum"),
    ), "bank_sums")
    mean = F.try_divide(F.col("rating_sum").cast("double"), F.col("rating_count").cast("double"))
    banks = sums.filter("rating_count > 0").select("bank_name", mean.alias("avg_rating"), "rating_count")
    total = sums.agg(F.sum("rating_sum").alias("rating_sum"), F.sum("rating_count").alias("rating_count")).select(mean).first()[0]
    joined = join_unique(facts.filter("final"), banks, ["bank_name"])
    rating, _ = R.impute_rating(
        F.col("review_rating_clean"), F.col("avg_rating"), F.col("rating_count"), F.lit(total).cast("double"))
    return joined.withColumn("review_rating", rating)


def live_star(spark: SparkSession, store: str) -> Star:
    """The star schema of a store, as its last batch left it."""
    return star_of_combinations(write_once(counted_reviews(write_once(combinations(spark, store), "combinations")), "counted"))


def live_reports(
    reviews: DataFrame, store: str, checkpoint: str, database: str | None = None, grain_safe: bool = True, **options
) -> StreamingQuery:
    """Take in new raw reviews and, with a ``database``, write its ten reports after every batch."""

    def refresh(spark: SparkSession, batch_id: int) -> None:
        star = live_star(spark, store)
        for name in REPORTS:
            write_replace(getattr(reports, name)(star, grain_safe), f"{database}.{name}")
        for name in SIMPLE_REPORTS:
            write_replace(getattr(reports, name)(star), f"{database}.{name}")

    return incremental_reviews(
        early_filter(reviews), store, checkpoint, describe=lambda rows: review_facts(rows, **options),
        after=refresh if database else None)
