"""Every registered query against its SQL in DuckDB, on whole tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from ebbtide.checks.oracles import oracle_sql
from ebbtide.checks.queries import QUERIES
from tests.conftest import DATA

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
# Same value types on both sides.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in NAMES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr),
    )


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    expected = duck.sql(oracle_sql()[name])
    assert table(df.columns, df.collect()) == table(expected.columns, expected.fetchall())
    kinds = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    assert kinds == dict(zip(expected.columns, map(str, expected.types)))


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 71
    assert df.columns[:2] == ["member_id", "is_churned"]
