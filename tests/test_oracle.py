"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from tests.conftest import SF_SMALL
from zonecast.oracle import queries_sql as oracle_sql
from zonecast.plans.catalog import QUERIES


def queries():
    return QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((0, "") if x is None else (1, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["GEOCODE", "GEONAME", "BOROUGH", "MEAN_POLLUANT", "W_TEMP", "W_WIND",
                          "W_DEWP", "NB_STATIONS"]
    assert df.count() == 25


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables absent")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    rel = duck.sql(oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in sdf.columns]
    got = _sorted([tuple(_norm(x) for x in r) for r in sdf.collect()])
    want = _sorted([tuple(_norm(r[i]) for i in order) for r in rel.fetchall()])
    assert got == want
