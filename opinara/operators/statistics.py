"""Per-bank and global rating statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _mean(total: str, count: str) -> Column:
    """Quotient of an exact decimal sum and a count; null for an empty group."""
    return F.try_divide(F.col(total).cast("double"), F.col(count).cast("double"))


def bank_rollup(df: DataFrame) -> DataFrame:
    """Sums and counts per bank over rated rows, plus ``n`` over all rows.

    One pass with map-side combine; both the bank and the global averages come
    from it.  Sums are decimal so that averages do not depend on row order.
    """
    rating = F.col("review_rating_clean")
    rated = rating.isNotNull()
    exact = rating.cast("decimal(3,1)")
    return df.groupBy("bank_name").agg(
        F.count("*").alias("n"),
        F.count(rating).alias("rating_count"),
        F.sum(exact).alias("rating_sum"),
        F.min(rating).alias("min_rating"),
        F.max(rating).alias("max_rating"),
        F.stddev_samp(exact.cast("double")).alias("rating_stddev"),
        F.sum(F.when(rated, F.col("bank_rating_decimal"))).alias("bank_rating_sum"),
        F.count(F.when(rated, F.col("bank_rating_decimal"))).alias("bank_rating_n"),
        F.sum(F.when(rated, F.col("normalized_length"))).alias("length_sum"),
        F.sum(F.when(rated, F.col("retention_percentage")).cast("decimal(18,2)")).alias("retention_sum"),
    )


def bank_statistics(df: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """Rating and text statistics of every bank with at least one rated review."""
    rollup = bank_rollup(df) if rollup is None else rollup
    return rollup.filter("rating_count > 0").select(
        "bank_name",
        _mean("rating_sum", "rating_count").alias("avg_rating"),
        "rating_count", "min_rating", "max_rating", "rating_stddev",
        _mean("bank_rating_sum", "bank_rating_n").alias("avg_bank_rating"),
        _mean("length_sum", "rating_count").alias("avg_text_length"),
        _mean("retention_sum", "rating_count").alias("avg_retention"),
    )


def global_stats(df: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """One row of averages over all rated reviews, rolled up from the bank sums."""
    rollup = bank_rollup(df) if rollup is None else rollup
    total = rollup.agg(*[
        F.sum(c).alias(c)
        for c in ("rating_sum", "rating_count", "bank_rating_sum", "bank_rating_n", "length_sum")
    ])
    return total.select(
        _mean("rating_sum", "rating_count").alias("global_avg_rating"),
        _mean("bank_rating_sum", "bank_rating_n").alias("global_avg_bank_rating"),
        _mean("length_sum", "rating_count").alias("global_avg_text_length"),
    )
