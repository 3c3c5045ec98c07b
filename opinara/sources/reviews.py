"""Raw reviews derived from the test ``documents`` table.

Every attribute of a review follows from a hash of its own text, so exact copies
of a document share bank, branch and date and meet again in de-duplication.  The
projection is narrow: no join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import spread

TEST_CITIES = [
    "Casablanca", "Rabat", "Fes", "Kenitra", "Tanger", "Agadir", "Oujda",
    "Marrakech", "Beni Mellal", "Mohammédia", "Tata", "Salé",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def hash_number(text: Column, part: int) -> Column:
    """A number below 2**28 from seven hex digits of md5(text)."""
    return F.conv(F.substring(F.md5(text), 1 + 7 * part, 7), 16, 10).cast("bigint")


def reviews_from_documents(docs: DataFrame) -> DataFrame:
    """Raw review columns, and ``doc_id``, of a documents table."""
    text, doc = F.col("text"), F.col("doc_id")
    h0, h1, h2 = (hash_number(text, i) for i in range(3))
    number = docs.select(
        "doc_id", "text", h0.alias("h0"), h1.alias("h1"), h2.alias("h2")
    )
    h0, h1, h2 = F.col("h0"), F.col("h1"), F.col("h2")
    bank = F.when(h0 % 97 != 0, F.concat(F.lit("Bank "), (h0 % 20).cast("string")))
    place = F.concat(
        F.lit("No "), (h2 % 3).cast("string"), F.lit(", "),
        F.element_at(F.array(*[F.lit(c) for c in TEST_CITIES]), (h1 % 12 + 1).cast("int")),
    )
    padded = F.when(doc % 5 == 0, F.concat(F.lit("  "), bank, F.lit(" "))).otherwise(bank)
    bank_rating = F.when(
        (h1 + doc) % 4 != 0,
        F.concat(((h1 + doc) % 8).cast("string"), F.lit(","), ((h0 + doc) % 10).cast("string")),
    )
    return number.select(
        "doc_id",
        padded.alias("bank_name"),
        F.concat(bank, F.lit(" - "), place).alias("branch_name"),
        bank_rating.alias("bank_rating"),
        place.alias("bank_location"),
        F.when(
            h2 % 53 != 0,
            F.date_format(
                F.date_add(F.lit("1995-01-01").cast("date"), (h2 % 2557).cast("int")), "yyyy-MM-dd"
            ),
        ).alias("review_date"),
        text.alias("review_text"),
        F.when((doc + h0) % 5 != 0, (h0 + doc * 7) % 9 - 1).cast("int").alias("review_rating"),
    )


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_from_documents(documents(spark, sf_dir))
