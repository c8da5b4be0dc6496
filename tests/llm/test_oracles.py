"""Operators that SQL can express, against their DuckDB statements."""

import duckdb
import pytest

from footfall.llm import queries
from footfall.sources.tables import TABLES
from tests.conftest import SF_ORACLE


@pytest.mark.parametrize("key", sorted(queries.all_oracles()))
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    df = queries.all_queries()[key](spark, SF_ORACLE)
    found = con.execute(queries.all_oracles()[key])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, found.fetchall()))
