"""Data-quality checks and profiles, each one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dq_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with the number of nulls in it."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count")


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count("*").alias("row_count")).filter("row_count > 1")
    )


def validate_sentiment(df: DataFrame) -> DataFrame:
    """Missing sentiment values and labels that contradict their score."""
    label, score = F.col("sentiment"), F.col("sentiment_score")
    return df.agg(
        F.count_if(label.isNull()).alias("missing_sentiment"),
        F.count_if(score.isNull()).alias("missing_scores"),
        F.count_if((label == "positive") & (score < 0)).alias("positive_with_negative_score"),
        F.count_if((label == "negative") & (score > 0)).alias("negative_with_positive_score"),
    )


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage share of every value of a column."""
    counts = df.groupBy(column).agg(F.count("*").alias("row_count"))
    total = df.agg(F.count("*").alias("total"))
    share = F.col("row_count").cast("double") * 100 / total.scalar()
    return counts.withColumn("share_pct", F.round(share, 6))


def column_profile(
    df: DataFrame, text: str, tokens: Column | None = None, confidence: str | None = None
) -> DataFrame:
    """Row, text and confidence figures of a review table in one row.

    ``tokens`` is the token array left by topic preprocessing.
    """
    c = F.col(text)
    aggs = [
        F.count("*").alias("row_count"),
        F.count(c).alias("non_null_count"),
        F.avg(F.length(c)).alias("mean_text_length"),
        F.count_if(F.trim(c) != "").alias("records_with_text"),
    ]
    if tokens is not None:
        aggs.append(F.count_if(F.size(tokens) == 0).alias("empty_after_preprocessing"))
    if confidence is not None:
        aggs.append(F.avg(confidence).alias("mean_confidence"))
    return df.agg(*aggs)
