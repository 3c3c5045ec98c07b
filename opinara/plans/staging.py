"""Raw reviews to cleaned reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratings as R
from ..functions import text as X
from ..functions.keys import review_id
from ..operators.dedup import dedup_reviews
from ..operators.keyed_join import join_unique
from ..operators.statistics import bank_rollup, bank_statistics, global_stats
from ..sources.scratch import write_once


def early_filter(df: DataFrame) -> DataFrame:
    return df.filter(X.is_valid_text("review_text", 3))


def keep_informative(df: DataFrame) -> DataFrame:
    """Rows with a text or a star count; zero stars count as none."""
    rating = F.when(F.col("review_rating") != 0, F.col("review_rating"))
    has_text = F.col("review_text").isNotNull() & (F.col("review_text") != "")
    return df.withColumn("review_rating", rating).filter(has_text | rating.isNotNull())


def normalise(
    df: DataFrame, scripts=("latin",), keep_negation: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Trimmed names, parsed ratings, cleaned text, text metrics and text choice; columns in ``keep`` stay.

    Rows whose cleaned text is too short stay in; ``text_selection`` drops them.
    Filtering here would evaluate the cleaning twice, in the filter and in the
    projection.
    """
    cleaned = df.select(
        F.trim("bank_name").alias("bank_name"),
        F.trim("branch_name").alias("branch_name"),
        R.parse_decimal_comma("bank_rating").alias("bank_rating_decimal"),
        F.trim("bank_location").alias("bank_location"),
        R.clamp_rating("review_rating").alias("review_rating_clean"),
        "review_date", "review_text", F.lower("review_text").alias("lower_text"), *keep,
    )
    cleaned = cleaned.withColumn(
        "cleaned_text", X.clean_text_basic("lower_text", scripts=scripts, lowered=True)
    )
    metrics = X.text_metrics(cleaned, "review_text", "cleaned_text")
    advanced = X.normalize_text(
        "lower_text", min_length=3, languages=["fr"], scripts=scripts, keep_negation=keep_negation,
        lowered=True,
    )
    return metrics.withColumn(
        "final_text", X.select_text("cleaned_text", advanced, "retention_percentage", "word_count")
    ).drop("review_text", "lower_text", "cleaned_text")


def text_selection(df: DataFrame) -> DataFrame:
    return df.filter(F.col("normalized_length") >= 3)


def is_final() -> Column:
    return (
        F.col("bank_name").isNotNull() & (F.col("bank_name") != "")
        & F.col("review_date").isNotNull() & X.is_valid_text("final_text", 3)
    )


def final_filter(df: DataFrame) -> DataFrame:
    return df.filter(is_final())


def impute(df: DataFrame, rollup: DataFrame) -> DataFrame:
    """Fill ratings from bank and global averages, with their provenance.

    ``rollup`` is the written ``bank_rollup`` of all cleaned reviews, also of
    those the final filter drops.
    """
    stats = bank_statistics(df, rollup).select(
        "bank_name", "avg_rating", "rating_count", "avg_bank_rating"
    )
    overall = global_stats(df, rollup).select(F.struct(
        F.col("global_avg_rating").alias("rating"), F.col("global_avg_bank_rating").alias("bank")
    )).first()[0]
    joined = join_unique(df, stats, ["bank_name"], "left", counts=rollup.select("bank_name", "n"))
    rating, source = R.impute_rating(
        F.col("review_rating_clean"), F.col("avg_rating"), F.col("rating_count"),
        F.lit(overall["rating"]).cast("double"),
    )
    bank_rating = R.impute_bank_rating(
        F.col("bank_rating_decimal"), F.col("avg_bank_rating"), F.lit(overall["bank"]).cast("double")
    )
    return joined.select(
        review_id("bank_name", "branch_name", "review_date", "final_text").alias("id"),
        "bank_name", "branch_name", bank_rating.alias("bank_rating"), "bank_location",
        F.col("review_date").try_cast("date").alias("review_date"), "final_text",
        rating.alias("review_rating"), source.alias("rating_source"),
        F.col("rating_count").alias("bank_rating_count"),
        F.round("avg_rating", 2).alias("bank_avg_rating"),
        X.text_quality("retention_percentage").alias("text_quality"),
        "retention_percentage", "review_rating_clean",
    )


def cleaned_reviews(raw: DataFrame, **options) -> DataFrame:
    """De-duplicated, normalised reviews, written once.

    Statistics, imputation and the final result all start from this table, so
    the shuffle and the text work happen once, and the statistics pass reads
    only its few numeric columns.
    """
    normal = normalise(dedup_reviews(early_filter(raw)), **options)
    return text_selection(write_once(normal, "cleaned_reviews"))


def staging(raw: DataFrame, processed_at: bool = True, order_columns: bool = False, **options) -> DataFrame:
    """The whole cleaning chain from raw to cleaned reviews.

    ``order_columns=True`` keeps the two columns that ``presentation_order`` reads.
    """
    df = cleaned_reviews(raw, **options)
    rollup = write_once(bank_rollup(df), "bank_rollup")
    out = impute(final_filter(df), rollup)
    if not order_columns:
        out = out.drop("retention_percentage", "review_rating_clean")
    return out.withColumn("processed_at", F.current_timestamp()) if processed_at else out


def presentation_order(df: DataFrame) -> list:
    """Sort order for display: rated rows, kept share, newest date, bank."""
    return [
        F.when(F.col("review_rating_clean").isNotNull(), 1).otherwise(2),
        F.col("retention_percentage").desc(), F.col("review_date").desc(), F.col("bank_name"),
    ]
