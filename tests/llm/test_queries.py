"""The operators' queries against their SQL, on the smallest test tables."""

import duckdb
import pytest

from opinara.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = con.execute(queries.ORACLE_SQL[name])
    names = sorted(c[0] for c in cursor.description)
    order = [c[0] for c in cursor.description]
    want = sorted(repr([row[order.index(c)] for c in names]) for row in cursor.fetchall())
    df = queries.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == names
    assert sorted(repr([row[c] for c in names]) for row in df.collect()) == want


def test_one_query_per_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))
