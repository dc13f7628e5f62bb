import pytest
from pyspark.sql import functions as F

from fieldstat.operators import joins as J


def codes(spark):
    return spark.createDataFrame([(1.0, "One"), (2.0, "Two"), (3.0, "Three")],
                                 "area_council double, area_council_desc string")


def facts(spark):
    rows = [("a", "1"), ("b", "2.0"), ("c", None), ("d", ""), ("e", "x"), ("f", "-999999999"),
            ("g", "9")]
    return spark.createDataFrame(rows, "id string, area_council string")


def test_mixed_type_label_join_drops_dirty_codes(spark):
    out = J.label_join(facts(spark), codes(spark), "area_council", "area_council",
                       {"area_council_desc": "Area_Council"})
    # the label replaces the same-named code column (names are case-insensitive)
    assert out.columns == ["id", "Area_Council"]
    assert sorted(map(tuple, out.collect())) == [("a", "One"), ("b", "Two")]


def test_unmatched_codes_shows_what_the_inner_join_drops(spark):
    out = J.unmatched_codes(facts(spark), codes(spark), "area_council", "area_council")
    assert sorted(r.id for r in out.collect()) == ["c", "d", "e", "f", "g"]


def test_text_codes_compare_as_text(spark):
    enum = spark.createDataFrame([("intBus7", "Name A")], "enum string, enumdesc string")
    acts = spark.createDataFrame([("1", "intBus7"), ("2", "intBus9")], "id string, originator string")
    out = J.label_join(acts, enum, "originator", "enum", ["enumdesc"])
    assert [tuple(r) for r in out.collect()] == [("1", "intBus7", "Name A")]


def test_checked_broadcast_hints_only_small_frames(spark):
    small = spark.range(10)
    big = spark.range(1000)
    out = J.checked_broadcast({"small": small, "big": big}, max_rows=100)
    assert "broadcast" in out["small"]._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in out["big"]._jdf.queryExecution().analyzed().toString().lower()


def test_label_join_uses_broadcast_for_checked_list(spark):
    lists = J.checked_broadcast({"c": codes(spark)})
    out = J.label_join(facts(spark), lists["c"], "area_council", "area_council", ["area_council_desc"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_exists_join_keeps_left_rows_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "id int, w string")
    out = J.exists_join(left, right, "id")
    assert out.columns == ["id", "v"]
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (3, "c")]


def test_merge_null_keys_suffixes_order(spark):
    x = spark.createDataFrame([(None, 1, "p"), (2, 2, "q"), (1, 3, "r")], "k int, n int, a string")
    y = spark.createDataFrame([(None, 10), (None, 11), (1, 12)], "k int, n int")
    out = J.merge_frames(x, y, "k")
    assert out.columns == ["k", "n.x", "a", "n.y"]
    rows = [tuple(r) for r in out.collect()]
    # sorted by key, missing last; missing matches missing (1 x 2 rows)
    assert rows[0] == (1, 3, "r", 12)
    assert sorted(rows[1:], key=str) == sorted([(None, 1, "p", 10), (None, 1, "p", 11)], key=str)
    plain = x.join(y, "k")
    assert plain.count() == 1  # a plain join loses the null keys


def test_label_join_check_size_flag(spark):
    out = J.label_join(facts(spark), codes(spark), "area_council", "area_council",
                       ["area_council_desc"], check_size=True)
    assert out.where(F.col("area_council_desc") == "One").count() == 1


def test_checked_broadcast_byte_bound(spark):
    wide = spark.range(50).select(F.repeat(F.lit("x"), 1000).alias("label"))
    out = J.checked_broadcast({"wide": wide}, max_rows=100, max_bytes=10_000)
    assert "broadcast" not in out["wide"]._jdf.queryExecution().analyzed().toString().lower()
    out = J.checked_broadcast({"wide": wide}, max_rows=100, max_bytes=1_000_000)
    assert "broadcast" in out["wide"]._jdf.queryExecution().analyzed().toString().lower()


def test_merge_matches_mixed_type_keys_as_text(spark):
    x = spark.createDataFrame([("1", 5), ("x", 6), ("2.5", 7)], "k string, n int")
    y = spark.createDataFrame([(1.0, "One"), (2.5, "Two and a half")], "k double, label string")
    out = J.merge_frames(x, y, "k")
    assert [tuple(r) for r in out.collect()] == [("1", 5, "One"), ("2.5", 7, "Two and a half")]


def test_label_join_can_return_the_list_code(spark):
    out = J.label_join(facts(spark), codes(spark), "area_council", "area_council",
                       {"area_council": "matched_code", "area_council_desc": "label"}, how="left")
    rows = {r.id: (r.matched_code, r.label) for r in out.collect()}
    assert rows["a"] == (1.0, "One") and rows["e"] == (None, None)


def test_merge_key_with_a_dot(spark):
    x = spark.createDataFrame([(1, "a")], "`k.1` int, v string")
    y = spark.createDataFrame([(1, "b")], "`k.1` int, w string")
    assert [tuple(r) for r in J.merge_frames(x, y, "k.1").collect()] == [(1, "a", "b")]


def test_dirty_codes_and_large_codes(spark):
    big = 9007199254740993
    lists = spark.createDataFrame([(1, "One"), (big, "Big"), (big - 1, "Near")], "code bigint, label string")
    rows = [("a", "1d"), ("b", "1f"), ("c", "NaN"), ("d", "007"), ("e", "1.0"), ("f", str(big)), ("g", " 1 "), ("h", "1.0000001")]
    facts = spark.createDataFrame(rows, "id string, k string")
    assert sorted(map(tuple, J.label_join(facts, lists, "k", "code", "label").select("id", "label").collect())) == [
        ("e", "One"), ("f", "Big"), ("g", "One")]
    whole = spark.createDataFrame([("x", big), ("y", big - 1)], "id string, k bigint")
    joined = J.label_join(whole, lists, "k", "code", "label")
    assert sorted(map(tuple, joined.select("id", "label").collect())) == [("x", "Big"), ("y", "Near")]
    assert "cast" not in joined._jdf.queryExecution().optimizedPlan().toString().lower()
    nan = spark.createDataFrame([(float("nan"), "NaN code")], "code double, label string")
    assert J.label_join(facts, nan, "k", "code", "label").count() == 0


def test_merge_with_several_keys_and_missing_parts(spark):
    x = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (1, 2, "c"), (None, 2, "d")], "k int, j int, v string")
    y = spark.createDataFrame([(1, None, "p"), (None, None, "q"), (1, 2, "r"), (1, 2, "s")], "k int, j int, w string")
    assert sorted((r.v, r.w) for r in J.merge_frames(x, y, ["k", "j"]).collect()) == [
        ("a", "p"), ("b", "q"), ("c", "r"), ("c", "s")]


def test_hot_keys_are_spread_over_cells(spark):
    """A key with a third of both sides' rows, and the missing key with another third."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    x = spark.range(600).select(key.alias("k"), F.col("id").alias("v"))
    y = spark.range(300).select(key.alias("k"), F.col("id").alias("w"))
    hot = {r.k: (r["__a"], r["__b"]) for r in J.hot_keys(x, y, ["k"], 16).collect()}
    assert set(hot) == {"hot", None} and all(a * b >= 8 for a, b in hot.values())
    merged = J.merge_frames(x, y, "k", sort=False)
    plain = J.merge_frames(x, y, "k", sort=False, spread=False)
    assert merged.columns == plain.columns
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, plain.collect()))
    cells = J._on_grid(x, J.hot_keys(x, y, ["k"], 16), ["k"], "__a", "__b").where("k = 'hot'")
    sizes = [r["count"] for r in cells.groupBy("__part__a", "__part__b").count().collect()]
    assert len(sizes) == hot["hot"][0] * hot["hot"][1] and max(sizes) <= 3 * 200 / hot["hot"][0]


def test_hot_keys_are_fewer_than_tasks(spark):
    x = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    assert J.hot_keys(x, x, ["k"], 8).count() == 0  # even keys need no grid
    assert J.hot_keys(x, x, ["k"], 200).count() <= 10
    none = x.where("false")
    assert J.hot_keys(x, none, ["k"], 8).count() == 0 and J.merge_frames(x, none.withColumnRenamed("v", "w"), "k").count() == 0


def test_hot_pairs_come_in_blocks_from_many_tasks(spark, monkeypatch):
    """Few values at a time, so that a stored result stays small, and no merging of cells that are small to read."""
    monkeypatch.setattr(J, "BLOCK_ROWS", 8)
    x = spark.range(400).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    y = spark.range(400).select(F.lit(7).alias("k"), F.col("id").alias("w"))
    rows = J.merge_frames(x, y, "k", sort=False).select("v", "w", F.spark_partition_id().alias("task")).collect()
    assert len({(r.v, r.w) for r in rows}) == len(rows) == 400 * 400
    assert len({r.task for r in rows}) >= 3
    again = sum(new.w == old.w for old, new in zip(rows, rows[8:]))  # a block is gone through once per row of the other
    assert again > 0.7 * len(rows)


def test_hot_cells_are_numbered_and_dealt_evenly(spark):
    """Two hot keys, the missing one with twice the pairs: each cell has a number, and no task gets several times another's pairs."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, -F.col("id"))
    x = spark.range(3000).select(key.alias("k"), F.col("id").alias("v"))
    y = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(7)).alias("k"), F.col("id").alias("w"))
    hot = sorted((r["__first"], r["__first"] + r["__a"] * r["__b"]) for r in J.hot_keys(x, y, ["k"], 8).collect())
    assert len(hot) == 2 and hot[0][0] == 0 and hot[0][1] == hot[1][0] and hot[1][1] >= 16
    merged = J.merge_frames(x, y, "k", sort=False).where("k = 7 OR k IS NULL")
    pairs = [r["count"] for r in merged.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(pairs) == 1000 * 300 + 1000 * 600
    assert len(pairs) == 16 and max(pairs) <= 2 * sum(pairs) / len(pairs)


@pytest.mark.parametrize("nx, ny", [(255, 257), (256, 512), (1, 700)])
def test_hot_keys_give_every_pair(spark, nx, ny):
    """Equal rows, missing keys, both zeros and NaN as keys, with and without columns beside the key."""
    def side(n, name, extra):
        hot = spark.range(n).select(F.explode(F.array(F.lit(None).cast("double"), F.lit(0.0), F.lit(float("nan")))).alias("k"),
                                    F.floor(F.col("id") / 3).alias(name))
        return hot.unionByName(spark.createDataFrame(extra, f"k double, {name} bigint"))
    x = side(nx, "v", [(1.0, 1), (2.0, 2), (-0.0, 3)])
    y = side(ny, "w", [(1.0, 5), (1.0, 5), (3.0, 6), (-0.0, 7)])
    assert J.hot_keys(x, y, ["k"], 8).count() == 3
    for other in (y, y.select("k")):
        got, plain = J.merge_frames(x, other, "k", sort=False), J.merge_frames(x, other, "k", sort=False, spread=False)
        assert got.schema.simpleString() == plain.schema.simpleString()
        count = lambda df: {tuple(map(str, r[:-1])): r[-1] for r in df.withColumn(
            "k", F.col("k").cast("string")).groupBy(*df.columns).count().collect()}
        assert count(got) == count(plain)


def test_merge_on_two_keys_and_clashing_names(spark):
    x = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (None, None, "c")], "k int, l int, v string")
    y = spark.createDataFrame([(1, None, "d"), (None, None, "e"), (1, 3, "f")], "k int, l int, v string")
    got = sorted(map(tuple, J.merge_frames(x, y, ["k", "l"]).collect()), key=repr)
    assert got == [(1, None, "a", "d"), (None, None, "c", "e")]
    assert J.merge_frames(x, y, ["k", "l"]).columns == ["k", "l", "v.x", "v.y"]


def test_code_combinations(spark):
    df = spark.createDataFrame([("1", "a"), ("1.0", "b"), ("9", "a"), ("9", "z"), (None, None), ("1d", "a")], "code string, name string")
    codes = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (None,)], "c double")
    names = spark.createDataFrame([("a",), ("b",), ("a",)], "n string")
    found = J.code_combinations(df, {"codes": ("code", codes, "c"), "names": ("name", names, "n")})
    assert {(r.unmatched, r.n_lists): r.n for r in found.collect()} == {("", 0): 2, ("codes", 1): 2, ("codes,names", 2): 2}
    assert {r.list_name: r.n for r in J.unmatched_per_list(found).collect()} == {"codes": 4, "names": 2}
    for name, (column, codelist, code) in {"codes": ("code", codes, "c"), "names": ("name", names, "n")}.items():
        assert J.unmatched_codes(df, codelist, column, code).count() == {"codes": 4, "names": 2}[name]
    assert J.code_combinations(df.where("false"), {"codes": ("code", codes, "c")}).count() == 0


def test_guarded_broadcast_needs_no_job_and_stops_a_long_list(spark):
    codes = spark.range(50).select((F.col("id") % 20).alias("code")).distinct().withColumn("label", F.col("code").cast("string"))
    df = spark.range(40).withColumnRenamed("id", "c")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    before = jobs()
    listed = J.guarded_broadcast(codes, 20)
    assert jobs() == before
    joined = J.label_join(df, listed, "c", "code", ["label"])
    assert joined.count() == 20 and "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="cannot be broadcast"):
        J.label_join(df, J.guarded_broadcast(codes, 19), "c", "code", ["label"]).count()
