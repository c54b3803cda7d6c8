"""Catalogue queries against their DuckDB twins at the smallest scale, and the driver entry."""

import datetime as dt
import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from waybill.plans import catalogue

DIR = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float | decimal.Decimal):
        return round(float(v), 6)
    return v.replace(tzinfo=None).isoformat() if isinstance(v, dt.datetime) else v


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        db.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return db


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DIR)
    twin = duck.sql(catalogue.ORACLES[name])
    assert sorted(df.columns) == sorted(twin.columns)
    at = [twin.columns.index(c) for c in df.columns]
    got = sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in twin.fetchall()), key=repr)


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["mes", "status", "total_viagens"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
