import pytest

from opinara import session
from opinara.plans import warehouse
from opinara.sources.reviews import reviews_raw


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS opinara_chain")
    yield "opinara_chain"
    spark.sql("DROP DATABASE opinara_chain CASCADE")


def test_whole_chain(spark, sf_dir, database):
    star = warehouse.refresh(reviews_raw(spark, sf_dir), database, topics=3, iterations=2)
    names = {t.name for t in spark.catalog.listTables(database)}
    assert {"cleaned_reviews", "enriched_reviews", "reviews", "fact_reviews", *warehouse.REPORTS} <= names
    cleaned = spark.table(f"{database}.cleaned_reviews").count()
    assert star.fact.count() == spark.table(f"{database}.reviews").count() == cleaned
    trends = spark.table(f"{database}.sentiment_trends").selectExpr("sum(review_count)").first()[0]
    assert trends == cleaned


def test_partition_sizing():
    assert session.shuffle_partitions(0, 8) == 16
    assert session.shuffle_partitions(100 << 40, 4000) == 819_200
