"""Every registered query against its oracle SQL in DuckDB, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else str(round(value, 6))
    return str(value)


def comparable(rows):
    return sorted([tuple(plain(v) for v in row) for row in rows])


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = df.select(*[f"`{c}`" for c in columns]).collect()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert comparable(got) == comparable([[r[i] for i in order] for r in cursor.fetchall()])


def test_entry(spark):
    assert contract.entry(spark).count() > 0
