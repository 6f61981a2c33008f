"""Every registered query against its DuckDB oracle on sf0.001."""

import datetime as dt
import math

import duckdb
import pytest

from __spark_entry__ import entry
from cohortgrid.plans.oracle import oracle_sql
from cohortgrid.plans.registry import queries
from cohortgrid.sources.tables import TABLE_NAMES
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.sql(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE", "date": "DATE"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()[:10]
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.mark.parametrize("key", sorted(queries()))
def test_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = con.sql(oracle_sql()[key])
    assert sorted(rel.columns) == cols
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == duck_types[f.name], (f.name, f.dataType, duck_types[f.name])
    idx = [rel.columns.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert got == exp


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns[:3] == ["mrn", "enrollment_start_date", "enrollment_end_date"]
    assert df.count() >= 1
