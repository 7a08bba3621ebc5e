"""Every registered query against its SQL, or for rows where it has none."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from flowloom.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(values, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(n for n, q in catalog().items() if q.sql))
def test_matches_sql(spark, engine, name):
    df = driver.queries()[name](spark, SF_DIR)
    got = _sorted_rows(df.columns, df.collect())
    cursor = engine.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = _sorted_rows(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    assert got == expected
    assert got


@pytest.mark.parametrize("name", sorted(n for n, q in catalog().items() if not q.sql))
def test_gives_rows(spark, name):
    assert driver.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows[0]["attack_type"] == "Benign"
    assert [r["rows"] for r in rows] == sorted((r["rows"] for r in rows), reverse=True)


def test_saved_model_scores_alike(spark):
    for name in ("save_model", "load_model"):
        rows = driver.queries()[name](spark, SF_DIR).collect()
        assert [r["alike"] for r in rows] == [True]
