"""Every query against its SQL, on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
import oracle
from opinara.plans.catalog import QUERIES

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((x is None, str(x)) for x in row))


def test_only_model_and_page_queries_lack_sql():
    missing = set(QUERIES) - set(oracle.build())
    assert missing == {"assign_topics", "pages_to_reviews"}


@pytest.mark.parametrize("name", sorted(oracle.build()))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = entry_point.queries()[name](spark, sf_dir)
    names = sorted(df.columns)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    columns = {c[0]: str(c[1]) for c in cursor.description}
    assert sorted(columns) == names
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == columns
    order = list(columns)
    want = [tuple(row[order.index(c)] for c in names) for row in cursor.fetchall()]
    assert ordered(tuple(r) for r in df.select(*names).collect()) == ordered(want)


@pytest.mark.parametrize("name", ["assign_topics", "pages_to_reviews"])
def test_other_queries_give_rows(spark, sf_dir, name):
    assert not entry_point.queries()[name](spark, sf_dir).isEmpty()


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["bank_name", "review_count", "avg_rating"]
