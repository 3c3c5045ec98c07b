"""Star schema: six dimensions around the review fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.dates import date_text
from ..functions.keys import score_text, surrogate_key
from ..functions.wordlists import COUNTRY
from ..sources.scratch import write_once


def _sentiment_id():
    return surrogate_key("sentiment", score_text("sentiment_score"))


def dim_bank(reviews: DataFrame) -> DataFrame:
    names = reviews.select("bank_name").filter("bank_name IS NOT NULL").distinct()
    return names.select(surrogate_key("bank_name").alias("bank_id"), "bank_name")


def dim_branch(reviews: DataFrame) -> DataFrame:
    """Branches of named banks.

    The bank key is a function of the bank name, so the lookup in ``dim_bank``
    comes down to dropping branches without a bank.
    """
    pairs = (
        reviews.select("bank_name", "branch_name")
        .filter("branch_name IS NOT NULL AND bank_name IS NOT NULL").distinct()
    )
    return pairs.select(
        surrogate_key("branch_name").alias("branch_id"),
        surrogate_key("bank_name").alias("bank_id"), "branch_name",
    )


def dim_date(reviews: DataFrame) -> DataFrame:
    days = (
        reviews.select(date_text("review_date").alias("day_text"))
        .filter("day_text IS NOT NULL").distinct()
    )
    day = F.col("day_text").cast("date")
    return days.select(
        surrogate_key("day_text").alias("date_id"), day.alias("full_date"),
        F.dayofmonth(day).alias("day"), F.month(day).alias("month"), F.year(day).alias("year"),
    )


def dim_location(reviews: DataFrame, region_from_city: bool = False) -> DataFrame:
    """One row per address; the key is per city and region."""
    places = geo.with_place(
        reviews.select("bank_location").distinct(), "bank_location", region_from_city
    )
    return places.select(
        surrogate_key("city", "region").alias("location_id"),
        "city", "region", F.lit(COUNTRY).alias("country"), "bank_location",
    )


def dim_sentiment(reviews: DataFrame) -> DataFrame:
    pairs = (
        reviews.select("sentiment", "sentiment_score").filter("sentiment IS NOT NULL").distinct()
    )
    return pairs.select(_sentiment_id().alias("sentiment_id"), "sentiment", "sentiment_score")


def dim_topic(reviews: DataFrame) -> DataFrame:
    """One row per topic and confidence; the key is per topic."""
    pairs = reviews.select("topic_name", "topic_confidence").filter("topic_name IS NOT NULL").distinct()
    return pairs.select(surrogate_key("topic_name").alias("topic_id"), "topic_name", "topic_confidence")


def _fact_keys() -> list[Column]:
    return [
        surrogate_key("bank_name").alias("bank_id"),
        surrogate_key("branch_name").alias("branch_id"),
        surrogate_key("city", "region").alias("location_id"),
        _sentiment_id().alias("sentiment_id"),
        surrogate_key("topic_name").alias("topic_id"),
        surrogate_key(date_text("review_date")).alias("date_id"),
    ]


def fact_reviews(reviews: DataFrame, region_from_city: bool = False) -> DataFrame:
    """One row per review with an address, and the keys of its dimensions.

    City and region follow from the address alone, so the address lookup in
    ``dim_location`` becomes a narrow projection: the fact needs no shuffle.
    """
    placed = geo.with_place(
        reviews.filter("bank_location IS NOT NULL"), "bank_location", region_from_city
    )
    return placed.select(F.col("id").alias("review_id"), *_fact_keys(), "final_text", "language", "review_rating")


def fact_combinations(counted: DataFrame, region_from_city: bool = False) -> DataFrame:
    """The fact of counted reviews: a row stands for ``copies`` reviews with the same keys and rating."""
    placed = geo.with_place(
        counted.filter("bank_location IS NOT NULL"), "bank_location", region_from_city
    )
    return placed.select(*_fact_keys(), "review_rating", F.col("n").alias("copies"))


@dataclass(frozen=True)
class Star:
    """The star schema as DataFrames; a fact with ``copies`` counts each row so often."""

    fact: DataFrame
    bank: DataFrame
    branch: DataFrame
    date: DataFrame
    location: DataFrame
    sentiment: DataFrame
    topic: DataFrame


def build_star(reviews: DataFrame, region_from_city: bool = False) -> Star:
    """Write every table of the star once; the reports read the written tables."""
    return _written_star(fact_reviews(reviews, region_from_city), reviews, region_from_city)


def star_of_combinations(counted: DataFrame, region_from_city: bool = False) -> Star:
    """The star of counted reviews, for the same reports."""
    return _written_star(fact_combinations(counted, region_from_city), counted, region_from_city)


def _written_star(fact: DataFrame, reviews: DataFrame, region_from_city: bool) -> Star:
    tables = {
        "fact": fact,
        "bank": dim_bank(reviews),
        "branch": dim_branch(reviews),
        "date": dim_date(reviews),
        "location": dim_location(reviews, region_from_city),
        "sentiment": dim_sentiment(reviews),
        "topic": dim_topic(reviews),
    }
    return Star(**{name: write_once(df, f"star_{name}") for name, df in tables.items()})
