"""Every registered query against its DuckDB oracle on the driver's tables
(sf0.001 here; the driver itself checks sf0.01)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as se
from footfall.plans.oracles import all_oracles
from footfall.plans.registry import all_queries
from footfall.sources.tables import TABLES

from .conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return v if v is None or isinstance(v, (int, bool)) else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns == ["area", "area_level", "product_id", "click_count", "city_infos",
                          "product_name", "product_status"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_query_matches_oracle(spark, duck, key):
    df = all_queries()[key](spark, SF_SMALL)
    got = df.collect()
    res = duck.execute(all_oracles()[key])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, got) == _rows(ocols, want)
