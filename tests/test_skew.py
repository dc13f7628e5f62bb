"""Hot keys: a third of the roster and of the paradata log moved onto one
establishment.  Results must still equal the oracle, and the row choice must
still be reduced map-side before its exchange."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.test_catalogue import canon

SRC = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events".split()
HOT = [
    "establishments_by_industry_year", "size_by_industry", "legal_status_in_year",
    "sales_by_industry", "employees_in_year", "skills_all_years", "pilot_extract",
    "fieldwork_monitor", "first_action", "errors_by_originator", "interviewer_errors",
    "sales_totals_by_year",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for t in TABLES:
        src = f"read_parquet('{SRC}/{t}.parquet')"
        if t == "orders":
            q = (f"SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END "
                 f"AS o_custkey) FROM {src}")
        elif t == "events":
            q = (f"SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END "
                 f"AS user_id) FROM {src}")
        else:
            q = f"SELECT * FROM {src}"
        con.execute(f"COPY ({q}) TO '{out}/{t}.parquet' (FORMAT PARQUET)")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{out}/{t}.parquet')")
    return str(out), con


@pytest.mark.parametrize("name", HOT)
def test_hot_key_results_equal_oracle(spark, skewed, name):
    sf, con = skewed
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert canon(df.columns, rows) == canon(rel.columns, orows)


def test_hot_key_row_choice_is_reduced_before_shuffle(spark, skewed):
    sf, _ = skewed
    df = E.queries()["size_by_industry"](spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
