import random

from pyspark.sql import functions as F

from fieldstat.operators import groups as G


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_representative_takes_all_columns_from_one_row(spark):
    df = spark.createDataFrame([(1, "2021", "b", 5), (1, "2019", "z", 9), (1, "2019", "a", 7),
                                (2, None, "c", 1), (2, "2020", "a", 0)],
                               "id int, year string, label string, n int")
    out = G.representative_rows(df, "id", ["year"])
    assert rows_of(out) == [(1, "2019", "a", 7), (2, None, "c", 1)]


def test_representative_is_deterministic_across_partitions(spark):
    data = [(k % 17, random.Random(k).choice(["2019", "2021", None]), k % 5, k) for k in range(500)]
    base = None
    for parts in (1, 2, 7):
        shuffled = data[:]
        random.Random(parts).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "id int, year string, a int, b int").repartition(parts)
        got = rows_of(G.representative_rows(df, "id", ["year", "a"]))
        base = base or got
        assert got == base


def test_having_on_representative_differs_from_prefilter(spark):
    # A5: the test applies to the chosen row; filtering first gives another answer
    df = spark.createDataFrame([(1, "2019"), (1, "2021"), (2, "2021")], "id int, year string")
    as_written = G.representative_rows(df, "id", ["year"]).where(F.col("year") == "2021")
    prefiltered = G.representative_rows(df.where(F.col("year") == "2021"), "id", ["year"])
    assert rows_of(as_written) == [(2, "2021")]
    assert rows_of(prefiltered) == [(1, "2021"), (2, "2021")]


def test_keep_first_uses_source_order(spark):
    df = spark.createDataFrame([("k1", "o1", 3, "late"), ("k1", "o1", 1, "early"), ("k1", "o2", 2, "x")],
                               "id string, originator string, line_no int, what string")
    out = G.keep_first(df, ["id", "originator"], ["line_no"])
    assert rows_of(out) == [("k1", "o1", 1, "early"), ("k1", "o2", 2, "x")]


def test_plan_reduces_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = G.representative_rows(df, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_bar_data_sums_per_bar(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), ("b", 1)], "x string, y int")
    assert rows_of(G.bar_data(df, "x", "y")) == [("a", 5), ("b", 1)]


def test_crosstab_and_totals(spark):
    df = spark.createDataFrame([("Mining", "2019"), ("Mining", "2019"), ("Mining", "2021"),
                                ("Retail", "2021")], "Industry string, Reference_Year string")
    ct = G.crosstab_count(df, "Industry", "Reference_Year", ["2019", "2021"])
    assert rows_of(ct) == [("Mining", 2, 1), ("Retail", None, 1)]
    tot = {(r.Industry, r.Reference_Year, r.total_level): r.n
           for r in G.crosstab_totals(df, "Industry", "Reference_Year").collect()}
    assert tot[(None, None, 3)] == 4
    assert tot[("Mining", None, 1)] == 3
    assert tot[(None, "2021", 2)] == 2
    assert tot[("Retail", "2021", 0)] == 1


def test_representative_skips_unsortable_map_columns(spark):
    df = spark.createDataFrame([(1, "b", {"k": 1}), (1, "a", {"k": 2})], "id int, v string, m map<string,int>")
    out = G.representative_rows(df, "id").collect()
    assert [(r.id, r.v, r.m) for r in out] == [(1, "a", {"k": 2})]


def test_distinct_totals_count_establishments_once(spark):
    """Totals are unions of the cells' sets, not sums of their counts."""
    from fieldstat.operators.groups import dense_numbers, distinct_totals
    rows = [(f"key-{i}", f"ind{j}", f"y{k}") for i in range(300) for j in range(2) for k in range(1 + (i % 3 == 0)) if (i + j) % 5]
    rows += [("key-7", None, "y0"), ("key-7", "ind0", None), (None, "ind0", "y0"), ("key-7", "ind0", "y0")]
    df = spark.createDataFrame(rows, "id string, industry string, year string").repartition(5)
    numbers = dense_numbers(df, "id")
    assert sorted(r.number for r in numbers.collect()) == list(range(numbers.count()))
    assert sorted(map(tuple, numbers.collect())) == sorted(map(tuple, dense_numbers(df.repartition(2), "id").collect()))
    got = {(r.industry, r.year, r.total_level): r.n
           for r in distinct_totals(df.join(numbers, "id", "left"), "industry", "year", "number").collect()}
    known = [r for r in rows if r[0] is not None]
    for industry, year, level in got:
        ids = {i for i, a, b in known if (level & 2 or a == industry) and (level & 1 or b == year)}
        assert got[(industry, year, level)] == len(ids)
    assert got[(None, None, 3)] == len({r[0] for r in known})
    assert len(got) == len({(a, b, 0) for _, a, b in known} | {(a, None, 1) for _, a, _ in known} | {(None, b, 2) for _, _, b in known}) + 1
    assert distinct_totals(df.where("false").withColumn("number", F.lit(1)), "industry", "year", "number").count() == 0
