"""Every registered query against its DuckDB oracle, on the smallest driver
tables (the driver runs the same check at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from fieldstat.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    return "NULL" if v is None else str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_is_registered_and_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


# Spark type name -> DuckDB type name, for the schema part of the check
DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
        "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    oracle_types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: DUCK.get(t, t) for c, t in df.dtypes} == oracle_types
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert canon(df.columns, rows) == canon(rel.columns, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Area_Council", "Province", "Reference_Year", "Industry",
                          "Number_Of_Establishments"]
