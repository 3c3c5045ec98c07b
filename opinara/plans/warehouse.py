"""The whole chain from raw reviews to published tables and report views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.sentiment import ArabicModel
from ..operators.topics import extract_topics
from ..sources.tables import read_table, write_replace, write_staging
from . import reports
from .enrichment import enrich
from .marts import (
    Star, dim_bank, dim_branch, dim_date, dim_location, dim_sentiment, dim_topic, fact_reviews,
)
from .staging import staging

REPORTS = ("branch_performance", "sentiment_trends", "topic_analysis", "customer_experience")
SIMPLE_REPORTS = (
    "reviews_by_sentiment_over_time", "sentiment_by_bank", "sentiment_by_topic", "volume_by_topic_sentiment",
    "branch_ranking_in_bank", "topic_share",
)


def refresh_reviews(
    raw: DataFrame, database: str, lexicon: DataFrame | None = None, language_model=None,
    arabic_score: ArabicModel | None = None, topics: int | None = None, **topic_options,
) -> DataFrame:
    """Clean, enrich and classify reviews; every step is a table the next one reads."""
    spark = raw.sparkSession
    cleaned, enriched, full = (f"{database}.{t}" for t in ("cleaned_reviews", "enriched_reviews", "reviews"))
    write_staging(staging(raw), cleaned)
    write_replace(enrich(read_table(spark, cleaned), lexicon, language_model, arabic_score), enriched)
    write_replace(extract_topics(read_table(spark, enriched), k=topics, **topic_options), full)
    return read_table(spark, full)


def refresh_star(reviews: DataFrame, database: str) -> Star:
    """Write the dimensions and the fact of classified reviews."""
    builders = {
        "fact": fact_reviews, "bank": dim_bank, "branch": dim_branch, "date": dim_date,
        "location": dim_location, "sentiment": dim_sentiment, "topic": dim_topic,
    }
    tables = {}
    for name, build in builders.items():
        table = f"{database}.fact_reviews" if name == "fact" else f"{database}.dim_{name}"
        write_replace(build(reviews), table)
        tables[name] = read_table(reviews.sparkSession, table)
    return Star(**tables)


def refresh_reports(star: Star, database: str, grain_safe: bool = True) -> None:
    """Write all ten reports."""
    for name in REPORTS:
        write_replace(getattr(reports, name)(star, grain_safe), f"{database}.{name}")
    for name in SIMPLE_REPORTS:
        write_replace(getattr(reports, name)(star), f"{database}.{name}")


def refresh(raw: DataFrame, database: str, grain_safe: bool = True, **options) -> Star:
    """Everything, in order."""
    star = refresh_star(refresh_reviews(raw, database, **options), database)
    refresh_reports(star, database, grain_safe)
    return star
