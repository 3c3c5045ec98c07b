"""Explicit schemas of the review tables."""

from pyspark.sql import types as T

REVIEW = T.StructType([
    T.StructField("bank_name", T.StringType()),
    T.StructField("branch_name", T.StringType()),
    T.StructField("bank_rating", T.StringType()),
    T.StructField("bank_location", T.StringType()),
    T.StructField("review_date", T.StringType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("review_rating", T.IntegerType()),
])

CLEANED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("bank_name", T.StringType()),
    T.StructField("branch_name", T.StringType()),
    T.StructField("bank_rating", T.DoubleType()),
    T.StructField("bank_location", T.StringType()),
    T.StructField("review_date", T.DateType()),
    T.StructField("final_text", T.StringType()),
    T.StructField("review_rating", T.DoubleType()),
    T.StructField("rating_source", T.StringType()),
    T.StructField("bank_rating_count", T.LongType()),
    T.StructField("bank_avg_rating", T.DoubleType()),
    T.StructField("text_quality", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
])

ENRICHED = T.StructType(CLEANED.fields + [
    T.StructField("language", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("sentiment_score", T.DoubleType()),
])

LEXICON = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("term", T.StringType()),
    T.StructField("weight", T.DoubleType()),
])

PAGE_REVIEW = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("relative_date", T.StringType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("stars", T.IntegerType()),
])
