"""Spot check of registered queries against their DuckDB oracle at sf0.001 (the full set runs
with tools/oracle_check.py)."""
import math
from pathlib import Path

import duckdb
import pytest

from conftest import SF_SMALL
from __spark_entry__ import entry, oracle_sql, queries
from pricewell.plans.catalog import QUERIES

NAMES = ["staging_totals", "reject_counts", "rejects", "moving_averages", "volatility_20d", "dim_instrument",
         "dim_date", "golden_crosses", "sector_index", "range_replace"]


def _norm(rows):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return repr(v) if isinstance(v, float) else str(v)
    return sorted("|".join(cell(v) for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF_SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = _norm(tuple(r[c] for c in cols) for r in sdf.collect())
    rel = duck.sql(oracle_sql()[name])
    idx = [rel.columns.index(c) for c in cols]
    exp = _norm(tuple(r[i] for i in idx) for r in rel.fetchall())
    assert sorted(rel.columns) == cols
    assert got == exp


def test_entry_runs(spark):
    rows = entry(spark).collect()
    assert len(rows) == 20
    assert rows == sorted(rows, key=lambda r: (-r.full_date.toordinal(), r.ticker))
