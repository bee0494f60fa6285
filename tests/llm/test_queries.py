"""Registered queries against their SQL in DuckDB, on whole tables."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from ebbtide.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA
from tests.test_oracles import NAMES, table


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) < set(queries()) and "pipeline" in queries()
    assert set(ORACLES) < set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for view in NAMES:
        con.sql(f"CREATE VIEW {view} AS SELECT * FROM '{DATA}/{view}.parquet'")
    df = QUERIES[name](spark, DATA)
    expected = con.sql(ORACLES[name])
    assert table(df.columns, df.collect()) == table(expected.columns, expected.fetchall())
