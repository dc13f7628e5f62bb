import pytest

from fieldstat.operators import reshape as P


def test_rename_first(spark):
    df = spark.createDataFrame([(1, 2)], "interview__key int, x int")
    assert P.rename_first(df).columns == ["id", "x"]


def test_drop_range_is_positional_and_inclusive(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], "id int, a__1 int, b int, a__2 int, c int, d int")
    assert P.drop_range(df, ("a__1", "a__2")).columns == ["id", "c", "d"]
    assert P.drop_range(df, ("a__1", "b"), ("c", "d")).columns == ["id", "a__2"]


def test_drop_range_missing_endpoint(spark):
    df = spark.createDataFrame([(1, 2)], "id int, a int")
    with pytest.raises(KeyError):
        P.drop_range(df, ("a", "zz"))


def test_cast_lists_are_one_projection(spark):
    df = spark.createDataFrame([("3.7", 2.0, "x")], "a string, b double, s string")
    out = P.to_category(P.to_integer(df, ["a", "a"]), ["b", "s"])
    assert out.dtypes == [("a", "int"), ("b", "string"), ("s", "string")]
    assert tuple(out.first()) == (3, "2", "x")
    with pytest.raises(KeyError):
        P.to_integer(df, ["nope"])


def test_to_integer_fast_path_keeps_r_semantics(spark):
    df = spark.createDataFrame([(5, 7), (-2147483648, None)], "a int, b bigint")
    out = P.to_integer(df, ["a", "b"])
    assert out.dtypes == [("a", "int"), ("b", "int")]
    assert [tuple(r) for r in out.collect()] == [(5, 7), (None, None)]
