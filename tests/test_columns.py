import datetime as dt
import math

from pyspark.sql import functions as F

from fieldstat.functions import columns as X


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_paste_prints_missing_as_na(spark):
    out = one(spark, X.paste("a", "b"), [("LS", "95"), (None, "7"), ("PS", None)], "a string, b string")
    assert out == ["LS 95", "NA 7", "PS NA"]


def test_epoch_day_drops_fraction(spark):
    out = one(spark, X.epoch_day("n"), [(0.0,), (19193.9,), (-1.5,), (None,), (float("nan"),),
                                        (1e12,), (float("inf"),)], "n double")
    assert out == [dt.date(1970, 1, 1), dt.date(2022, 7, 20), dt.date(1969, 12, 30), None,
                   None, None, None]


def test_epoch_day_beyond_year_9999(spark):
    days = [(1e7,), (2147483647.0,), (-2147483648.0,), (2147483648.0,)]
    assert one(spark, F.unix_date(X.epoch_day("n")), days, "n double") == [10_000_000, 2147483647, -2147483648, None]


def test_as_integer_edges(spark):
    vals = [("3.7",), ("-3.7",), ("abc",), ("3e9",), ("NaN",), ("-2147483648",), ("12",), (None,),
            ("2147483647",), ("1d",), ("1f",), ("Infinity",), ("007",), (" 7 ",), ("1e3",), (".5",), ("-",)]
    out = one(spark, X.as_integer("x"), vals, "x string")
    assert out == [3, -3, None, None, None, None, 12, None, 2147483647, None, None, None, 7, 7, 1000, 0, None]


def test_as_integer_on_doubles(spark):
    out = one(spark, X.as_integer("x"), [(3.7,), (-3.7,), (float("nan"),), (3e9,), (float("inf"),)],
              "x double")
    assert out == [3, -3, None, None, None]


def test_category_text(spark):
    out = one(spark, X.category_text("x"), [(1.0,), (2.5,), (None,), (-0.25,), (120000000.0,),
                                            (0.1 + 0.2,)], "x double")
    assert out == ["1", "2.5", None, "-0.25", "120000000", "0.3"]
    assert one(spark, X.category_text("s"), [("abc",), ("3",), ("007",), ("1e3",)], "s string") == [
        "abc", "3", "007", "1e3"]


def test_category_text_has_15_digits_in_fixed_notation(spark):
    out = one(spark, X.category_text("x"), [(1e-20,), (123456.789012345678,), (5619.52 / 7,), (1e15,), (-1e-5,),
                                            (1e22,), (0.0,), (1 / 3,)], "x double")
    assert out == ["0.00000000000000000001", "123456.789012346", "802.788571428571", "1000000000000000", "-0.00001",
                   "10000000000000000000000", "0", "0.333333333333333"]


def test_paste_prints_numbers_like_r(spark):
    assert one(spark, X.paste("a", "b"), [("LS", 95.0), ("LS", 2.5), ("LS", None)], "a string, b double") == [
        "LS 95", "LS 2.5", "LS NA"]


def test_fill_missing(spark):
    df = spark.createDataFrame([(None, None), ("a", 3)], "c string, n int")
    rows = df.select(X.fill_missing("c", ""), X.fill_missing("n", 0)).collect()
    assert [tuple(r) for r in rows] == [("", 0), ("a", 3)]


def test_time_text_functions(spark):
    df = spark.createDataFrame([("2022-07-20T10:11:12",), ("07/20/2022 10:11:12",), ("junk",),
                                ("7/2/2022 1:02:03",), ("7-2-2022 01:2:3",)], "t string")
    rows = df.select(X.time_text("t"), X.time_of_day_text("t"),
                     X.parse_time("t").cast("timestamp_ntz")).collect()
    assert rows[0][0] == "2022-07-20 10:11:12"
    assert rows[0][1] == "10:11:12"
    assert rows[0][2] == dt.datetime(2022, 7, 20, 10, 11, 12)
    assert rows[1][2] == dt.datetime(2022, 7, 20, 10, 11, 12)
    assert rows[2][2] is None
    assert rows[3][2] == rows[4][2] == dt.datetime(2022, 7, 2, 1, 2, 3)


def test_minutes_between_is_fractional_end_minus_start(spark):
    df = spark.createDataFrame([("2022-07-20 10:00:00", "2022-07-20 10:01:30")], "s string, e string")
    m = df.select(X.minutes_between(F.to_timestamp("s"), F.to_timestamp("e"))).first()[0]
    assert math.isclose(m, 1.5)


def test_positive_code(spark):
    vals = [("1",), ("0",), ("-999999999",), ("",), (None,), ("x",), ("2.5",)]
    out = one(spark, X.positive_code("p"), vals, "p string")
    assert out == [True, False, False, None, None, None, True]


def test_label_in_matches_text_or_number(spark):
    # two texts compare as text; a number compares as a number
    df = spark.createDataFrame([("2019",), ("2019.0",), ("2019d",), ("2021",), ("x",), (None,)], "y string")
    out = [r[0] for r in df.select(X.label_in("y", ["2019", "x"])).collect()]
    assert out == [True, False, False, False, True, None]
    nums = spark.createDataFrame([(2019.0,), (2020.0,)], "y double")
    assert [r[0] for r in nums.select(X.label_in("y", ["2019"])).collect()] == [True, False]
