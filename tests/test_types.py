"""Guessed types (S2) and chosen time forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldstat.functions import columns as X
from fieldstat.sources import apply_types, guess_types, read_guessed


@pytest.mark.parametrize("values,kind", [
    (["1", " 2.5 ", "-3e2", None, "NA", ""], "double"), (["1", "1d"], "string"), (["007", "12"], "string"),
    (["0", "0.5", "-.5"], "double"), (["T", "false", "TRUE", None], "boolean"), (["T", "1"], "string"),
    (["2022-01-31", "2022/2/3", "NA"], "date"), (["2022-02-30"], "string"),
    (["2022-01-31", "2022-01-31 10:20:30"], "timestamp_ntz"), (["2022-01-31T10:20", "2022-01-31T10:20:30.25"], "timestamp_ntz"),
    (["2022-01-31 25:00:00"], "string"), ([None, "", "NA"], "string"), ([], "string"), (["Infinity"], "string"),
])
def test_one_column(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string").repartition(3)
    assert guess_types(df) == {"a.b": kind}
    out = read_guessed(df)
    assert dict(out.dtypes)["a.b"] == kind
    held = sum(v is not None and v.strip() not in ("", "NA") for v in values)
    if kind != "string":
        assert out.where(F.col("`a.b`").isNotNull()).count() == held


def test_every_row_counts(spark):
    """One odd value among very many decides: nothing is sampled."""
    df = spark.range(50_000).select(F.when(F.col("id") == 49_123, "x").otherwise(F.col("id").cast("string")).alias("c"),
                                    F.col("id").cast("string").alias("d"))
    assert guess_types(df) == {"c": "string", "d": "double"}
    assert guess_types(df, ["d"]) == {"d": "double"}
    assert guess_types(spark.range(3)) == {}


def test_many_columns_in_one_aggregate(spark):
    df = spark.range(20).select(*[(F.col("id") + i).cast("string").alias(f"c{i}") for i in range(150)])
    assert set(guess_types(df).values()) == {"double"}


def test_values_read(spark):
    df = spark.createDataFrame([("t", "2022-1-5", "2022-01-05 01:02:03"), ("F", "NA", "2022-01-06")], "a string, b string, c string")
    rows = apply_types(df, {"a": "boolean", "b": "date", "c": "timestamp_ntz"}).collect()
    assert [tuple(r) for r in rows] == [(True, dt.date(2022, 1, 5), dt.datetime(2022, 1, 5, 1, 2, 3)),
                                        (False, None, dt.datetime(2022, 1, 6))]


WANT = dt.datetime(2022, 3, 4, 15, 6, 7)


@pytest.mark.parametrize("form,text", [
    ("iso", "2022-03-04T15:06:07"), ("iso", "2022-3-4 15:6:7"), ("mdy", "3/4/2022 15:06:07"), ("dmy", "04.03.2022 15:06:07"),
    ("mdy am/pm", "03/04/2022 03:06:07 pm"), ("dmy am/pm", "4-3-2022 3:06:07PM"), ("mdy short year", "3/4/22 15:06:07"),
    ("dmy short year", "4.3.22 15:6:7"), ("month name first", "March 4, 2022 15:06:07"), ("month name first", "mar 4 2022  15:06:07"),
    ("month name second", "4 MARCH 2022 15:06:07")])
def test_time_forms(spark, form, text):
    assert set(X.TIME_FORMS) == {"iso", "mdy", "dmy", "mdy am/pm", "dmy am/pm", "mdy short year", "dmy short year",
                                 "month name first", "month name second"}
    row = spark.createDataFrame([(text, "31.02.2022 99:00:00")], "t string, bad string").select(
        X.read_time("t", form).alias("t"), X.read_time("bad", form).alias("bad")).first()
    assert row.t == WANT and row.bad is None


def test_short_years(spark):
    df = spark.createDataFrame([("1/2/68 1:2:3",), ("1/2/69 1:2:3",)], "t string")
    assert [r.t.year for r in df.select(X.read_time("t", "mdy short year").alias("t")).collect()] == [2068, 1969]


def test_form_is_chosen_by_all_values(spark):
    """Days above 12 settle the order of day and month; what does not fit is missing."""
    df = spark.createDataFrame([("3/4/2022 1:2:3", "March 4 2022 1:2:3"), ("13/4/2022 1:2:3", "April 5, 2022 1:2:3"), ("x", "4/3/2022 1:2:3")],
                               "a string, b string").repartition(2)
    assert X.choose_time_forms(df, ["a", "b"]) == {"a": "dmy", "b": "month name first"}
    got = {str(r.a) for r in X.parse_times(df, ["a", "b"]).collect()}
    assert got == {"2022-04-03 01:02:03", "2022-04-13 01:02:03", "None"}
    ambiguous = spark.createDataFrame([("3/4/2022 1:2:3",)], "a string")
    assert X.choose_time_forms(ambiguous, ["a"]) == {"a": "mdy"}
