"""Registered queries on the driver tables, with their DuckDB oracle SQL.

Each query runs the library's own operators and plans over the stand-in
census tables (``standins``), on whole tables.  The oracle is written
independently in plain SQL: bare-column groups become ``ROW_NUMBER()``
CTEs with the same total order, label joins become ``TRY_CAST`` joins.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstat.functions import columns as X
from fieldstat.operators import groups as G
from fieldstat.operators import joins as J
from fieldstat.operators import reshape as P
from fieldstat.plans import marts, quality, reports
from fieldstat.plans.standins import census_tables, read_tables
from fieldstat.session import checkpoint_root
from fieldstat.sinks.quoted_csv import csv_document, quoted_csv_lines, read_manifest, write_quoted_csv
from fieldstat.sources.delimited import read_delimited
from fieldstat.sources.archive import explode_blocks, read_member
from fieldstat.sources.records import number_records, records, with_quote_state
from fieldstat.sinks.layers import read_layer, store_code_lists, write_layer
from fieldstat.sources.codelists import load_code_lists
from fieldstat.sources.extract import extract_status
from fieldstat.sources.types import read_guessed

Query = Callable[[SparkSession, str], DataFrame]

# Stand-in parameters: the order years are 1995..2001, so the reports'
# year tests use two of those in place of 2019/2021.
YEARS = ("1996", "1998")
YEAR = "1996"


def _t(spark, sf, **wanted):
    return census_tables(spark, sf, **wanted)


def _ind(t):
    return marts.industry(t)


def _src(spark, sf, *names):
    return read_tables(spark, sf, names)


# Codes as they come in exports: what reads as a number and what does not.
DIRTY = {0: None, 1: "1d", 2: "1f", 3: "NaN", 4: "007", 5: " 5", 6: "6e0", 7: "x7", 8: "", 9: "Infinity"}
#: Added to a code, it is beyond what a double holds exactly.
BIG = 9007199254740993


def _dirty_codes(customer: DataFrame) -> DataFrame:
    """Area codes stored as text with the usual faults: whole numbers with a
    ``.0``, texts that only look like numbers, blanks and missing values."""
    c = F.col("c_nationkey").cast("string")
    code = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(c, F.lit(".0")))
    for key, text in DIRTY.items():
        code = code.when((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_nationkey") == key), F.lit(text))
    code = code.when(F.col("c_mktsegment") == "BUILDING", (F.col("c_nationkey") + F.lit(BIG)).cast("string"))
    return customer.select("c_custkey", code.otherwise(c).alias("area_code"))


def _big_codes(nation: DataFrame) -> DataFrame:
    """The list twice: its own codes, and the same ones beyond 2**53."""
    labels = nation.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name")
    return labels.unionByName(labels.select((F.col("n_nationkey") + F.lit(BIG)).alias("n_nationkey"),
                                            F.concat("n_name", F.lit(" (big)")).alias("n_name")))


_DIRTY_CASES = "\n".join(
    f"              WHEN c_mktsegment = 'MACHINERY' AND c_nationkey = {k} THEN {'NULL' if v is None else repr(v)}"
    for k, v in DIRTY.items())
DIRTY_SQL = f"""dirty AS (
  SELECT c_custkey,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN CAST(c_nationkey AS VARCHAR) || '.0'
{_DIRTY_CASES}
              WHEN c_mktsegment = 'BUILDING' THEN CAST(c_nationkey + {BIG} AS VARCHAR)
              ELSE CAST(c_nationkey AS VARCHAR) END AS area_code
  FROM customer),
big AS (
  SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation
  UNION ALL SELECT n_nationkey + {BIG}, n_name || ' (big)' FROM nation),
coded AS (
  SELECT *, CASE WHEN regexp_full_match(trim(area_code), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
                 THEN CAST(CAST(trim(area_code) AS DECIMAL(38,6)) AS HUGEINT) END AS code FROM dirty)"""


# ---------------------------------------------------------------- joins ----

def q_label_join(spark, sf):
    s = _src(spark, sf, "customer", "nation")
    c = s["customer"].select("c_custkey", "c_name", F.when(
        F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey") + F.lit(BIG)).otherwise(F.col("c_nationkey")).alias("code"))
    return J.label_join(c, _big_codes(s["nation"]), "code", "n_nationkey", {"n_name": "nation_label"}).drop("code")


def q_mixed_type_label_join(spark, sf):
    s = _src(spark, sf, "customer", "nation")
    return J.label_join(_dirty_codes(s["customer"]), _big_codes(s["nation"]), "area_code", "n_nationkey",
                        {"n_name": "area_label"})


def q_unmatched_codes(spark, sf):
    s = _src(spark, sf, "customer", "nation")
    return J.unmatched_codes(_dirty_codes(s["customer"]), _big_codes(s["nation"]), "area_code", "n_nationkey")


def q_star_labels(spark, sf):
    s = _src(spark, sf, "orders", "customer", "nation", "region")
    o = s["orders"].select("o_orderkey", F.col("o_custkey").alias("id"))
    c = s["customer"].select(F.col("c_custkey").alias("id"), "c_name", "c_nationkey")
    j = o.join(c, "id")
    j = J.label_join(j, s["nation"], "c_nationkey", "n_nationkey",
                     {"n_name": "area_council_desc", "n_regionkey": "region_code"})
    j = J.label_join(j, s["region"], "region_code", "r_regionkey", {"r_name": "province_desc"})
    return j.select("o_orderkey", "id", "c_name", "area_council_desc", "province_desc")


def q_roster_fanout(spark, sf):
    s = _src(spark, sf, "orders", "lineitem")
    o = s["orders"].select(F.col("o_custkey").alias("id"), "o_orderkey")
    li = s["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
                              "l_quantity", "l_extendedprice")
    return o.join(li, "o_orderkey")


def q_exists_join(spark, sf):
    s = _src(spark, sf, "orders", "customer")
    o = s["orders"].select("o_orderkey", F.col("o_custkey").alias("id"), "o_totalprice")
    households = s["customer"].where(F.col("c_mktsegment") == "HOUSEHOLD").select(
        F.col("c_custkey").alias("id"))
    return J.exists_join(o, households, "id")


def q_merge_null_keys(spark, sf):
    s = _src(spark, sf, "customer", "nation")
    x = s["customer"].select("c_custkey", F.nullif("c_nationkey", F.lit(0)).alias("nation_code"))
    y = s["nation"].select(F.nullif("n_nationkey", F.lit(0)).alias("nation_code"), "n_name")
    return J.merge_frames(x, y, "nation_code")


def q_merge_suffixes(spark, sf):
    t = _t(spark, sf)
    a = t["interview_actions"].groupBy("id").agg(F.count(F.lit(1)).alias("n"),
                                                 F.max("time").alias("last_action"))
    e = t["errors"].groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return J.merge_frames(a, e, "id", spread=False)


def q_merge_heavy_keys(spark, sf):
    """J8 with a key (and the missing key) that a third of one side's rows have."""
    s = _src(spark, sf, "orders", "customer")
    key = F.col("o_orderkey") % 3
    x = s["orders"].select("o_orderkey", "o_totalprice", F.when(key == 0, F.lit(7)).when(
        key == 1, F.col("o_custkey") % 1000 + 100).alias("code"))
    y = s["customer"].where("c_custkey % 50 = 0").select("c_custkey", "c_name", F.when(
        F.col("c_custkey") % 200 == 0, F.lit(7)).when(F.col("c_custkey") % 200 == 50, F.col("c_custkey") % 1000 + 100).alias("code"))
    return J.merge_frames(x, y, "code", sort=False)


def q_code_combinations(spark, sf):
    """F4 for three lists in one scan: rows by the lists that do not know them, and per list."""
    s = _src(spark, sf, "customer", "nation", "region")
    c = _dirty_codes(s["customer"]).join(s["customer"].select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey")
    c = c.withColumn("segment", F.lower("c_mktsegment"))
    segments = s["customer"].where("c_nationkey < 3").select(F.lower("c_mktsegment").alias("name")).where(
        "name <> 'machinery'").distinct()
    found = J.code_combinations(c, {"area": ("area_code", _big_codes(s["nation"]), "n_nationkey"),
                                    "region": ("c_nationkey", s["region"], "r_regionkey"),
                                    "segment": ("segment", segments, "name")})
    found = spark.createDataFrame(found.toArrow())  # at most one row per combination of three lists
    each = J.unmatched_per_list(found).select(F.lit("list").alias("level"), F.col("list_name").alias("unmatched"), "n")
    return found.select(F.lit("combination").alias("level"), "unmatched", "n").unionByName(each)


# ------------------------------------------------------ quality / charts ---

def q_positive_code_count(spark, sf):
    return quality.interviews_per_province(_t(spark, sf))


def q_errors_by_variable(spark, sf):
    return quality.errors_by_variable(_t(spark, sf))


def q_errors_by_interview(spark, sf):
    return quality.errors_by_interview(_t(spark, sf))


def q_first_action(spark, sf):
    return quality.first_action(_t(spark, sf))


def q_interviewer_errors(spark, sf):
    return quality.interviewer_errors(_t(spark, sf))


def q_errors_by_originator(spark, sf):
    return quality.errors_by_originator(_t(spark, sf))


# ----------------------------------------------------------- marts ---------

def q_sector_union(spark, sf):
    return _ind(_t(spark, sf))


def q_fieldwork_monitor(spark, sf):
    return marts.fieldwork_monitor(_t(spark, sf))


def q_fieldwork_durations(spark, sf):
    return marts.interview_durations(marts.fieldwork_monitor(_t(spark, sf)))


def q_fieldwork_industry(spark, sf):
    return marts.fieldwork_industry(_t(spark, sf))


def q_fieldwork_export_lines(spark, sf):
    t = _t(spark, sf)
    return csv_document(spark, marts.fieldwork_industry(t), sort_by=["id", "IndustryType"])


# ----------------------------------------------------------- reports -------

def q_establishments_by_industry_year(spark, sf):
    t = _t(spark, sf)
    return reports.establishments_by_industry_year(t, _ind(t))


def q_size_by_industry(spark, sf):
    t = _t(spark, sf)
    return reports.size_by_industry(t, _ind(t), YEARS)


def q_legal_status_in_year(spark, sf):
    t = _t(spark, sf)
    return reports.legal_status_in_year(t, _ind(t), YEAR)


def q_sales_by_industry(spark, sf):
    t = _t(spark, sf)
    return reports.sales_by_industry(t, _ind(t), YEARS)


def q_employees_in_year(spark, sf):
    t = _t(spark, sf, measures=True, years=[YEAR])
    return reports.employees_in_year(t, _ind(t), YEAR)


def q_compensation_in_year(spark, sf):
    t = _t(spark, sf, measures=True, years=[YEAR])
    return reports.compensation_in_year(t, _ind(t), YEAR)


def q_skills_all_years(spark, sf):
    t = _t(spark, sf, measures=True)
    return reports.skills_all_years(t, _ind(t))


def q_pilot_extract(spark, sf):
    return reports.pilot_extract(_t(spark, sf))


def q_legal_status_by_year(spark, sf):
    t = _t(spark, sf)
    return reports.legal_status_by_year(t, _ind(t), YEAR)


def q_size_by_industry_by_year(spark, sf):
    t = _t(spark, sf)
    rows = reports.size_sales_rows(t, _ind(t), YEARS, filter_first=True)
    return reports.size_by_industry(t, _ind(t), YEARS, rows=rows)


def q_sales_by_industry_by_year(spark, sf):
    t = _t(spark, sf)
    rows = reports.size_sales_rows(t, _ind(t), YEARS, filter_first=True)
    return reports.sales_by_industry(t, _ind(t), YEARS, rows=rows)


def q_size_totals_by_year(spark, sf):
    t = _t(spark, sf)
    return reports.measure_totals_by_year(t, _ind(t), ["tot_paid_emp"], YEARS)


def q_sales_totals_by_year(spark, sf):
    t = _t(spark, sf)
    return reports.measure_totals_by_year(t, _ind(t), ["sales_goods_services"], YEARS)


def q_employee_totals_by_year(spark, sf):
    t = _t(spark, sf, measures=True, years=YEARS)
    return reports.measure_totals_by_year(t, _ind(t), list(reports.EMPLOYEE_MEASURES), YEARS)


def q_skill_totals_by_year(spark, sf):
    t = _t(spark, sf, measures=True, years=YEARS)
    return reports.measure_totals_by_year(
        t, _ind(t), list(reports.COMPENSATION_MEASURES) + list(reports.SKILL_MEASURES), YEARS)


def q_industry_year_crosstab(spark, sf):
    t = _t(spark, sf)
    values = G.pivot_values(t["reference_year"], "reference_year_desc")
    return G.crosstab_count(reports.industry_years(t, _ind(t)), "Industry", "Reference_Year", values, weight="n")


def q_industry_year_totals(spark, sf):
    t = _t(spark, sf)
    return G.crosstab_totals(reports.industry_years(t, _ind(t)), "Industry", "Reference_Year", weight="n")


def q_table_1_pivot(spark, sf):
    """A9 as the reference has it: rows of Table_1 per Industry and year."""
    t = _t(spark, sf)
    values = G.pivot_values(t["reference_year"], "reference_year_desc")
    table_1 = reports.establishments_by_industry_year(t, _ind(t), sort=False)
    return G.crosstab_count(table_1, "Industry", "Reference_Year", values)


# ----------------------------------------------------- scalar functions ----

def q_cast_integer(spark, sf):
    p = _src(spark, sf, "part")["part"]
    return p.select(
        "p_partkey",
        X.as_integer((F.col("p_retailprice") / 7).cast("string")).alias("from_text"),
        X.as_integer(-F.col("p_retailprice") / 7).alias("from_negative"),
        X.as_integer(F.col("p_retailprice") * 1e7).alias("from_too_large"),
        X.as_integer("p_brand").alias("from_label"),
        X.as_integer(F.concat(F.lit("00"), F.col("p_size").cast("string"))).alias("from_padded"),
        X.as_integer(F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") % 3 == 0, "d")
                              .when(F.col("p_size") % 3 == 1, "f").otherwise("e1"))).alias("from_suffixed"),
        X.as_integer(F.col("p_size").cast("string")).alias("from_int_text"),
    )


def q_to_integer_columns(spark, sf):
    c = _src(spark, sf, "customer")["customer"]
    df = c.select("c_custkey", F.col("c_acctbal").cast("string").alias("acctbal_text"),
                  (F.col("c_acctbal") * 1000).alias("acctbal_milli"))
    return P.to_integer(df, ["acctbal_text", "acctbal_milli", "acctbal_text"])


def q_category_text(spark, sf):
    c = _src(spark, sf, "customer")["customer"]
    return c.select("c_custkey", X.category_text("c_acctbal").alias("acctbal_label"),
                    X.category_text(F.col("c_nationkey").cast("double")).alias("nation_label"),
                    X.category_text("c_mktsegment").alias("segment_label"),
                    X.category_text(F.col("c_acctbal") / 7).alias("digits_label"),
                    X.category_text(F.col("c_custkey") * 1e-20).alias("tiny_label"),
                    X.category_text(F.concat(F.lit("00"), "c_nationkey")).alias("text_label"))


def q_epoch_day_to_date(spark, sf):
    o = _src(spark, sf, "orders")["orders"]
    d = o.select("o_orderkey", (F.unix_date(F.to_date("o_orderdate")).cast("double") + 0.75)
                 .alias("day_number"))
    late = X.epoch_day(F.lit(2932896.0) + F.col("o_orderkey"))  # beyond the year 9999
    return d.withColumn("order_day", X.epoch_day("day_number")).withColumn("late_day", F.unix_date(late))


def q_paste_missing(spark, sf):
    c = _src(spark, sf, "customer")["customer"]
    return c.select("c_custkey",
                    X.paste(F.nullif("c_mktsegment", F.lit("HOUSEHOLD")), "c_nationkey")
                    .alias("Reference_Number"),
                    X.paste(F.lit("LS"), F.col("c_nationkey").cast("double"), F.col("c_nationkey") / 4)
                    .alias("number_parts"))


def q_clean_time_text(spark, sf):
    e = _src(spark, sf, "events")["events"]
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return e.select("event_id", iso.alias("iso_text"), X.time_text(iso).alias("spaced_text"),
                    X.time_of_day_text(iso).alias("clock_text"),
                    X.parse_time(iso).cast("timestamp_ntz").alias("parsed"),
                    *[X.parse_time(F.date_format("ts", f)).cast("timestamp_ntz").alias(name) for name, f in (
                        ("parsed_mdy", "M/d/yyyy H:mm:ss"), ("parsed_dashes", "MM-dd-yyyy HH:mm:ss"),
                        ("parsed_dots", "M.d.yyyy H:m:s"))])


def q_minutes_between(spark, sf):
    e = _src(spark, sf, "events")["events"]
    return e.select("event_id", X.minutes_between(F.to_date("ts"), "ts").alias("minutes"))


def q_fill_missing(spark, sf):
    c = _src(spark, sf, "customer")["customer"]
    return c.select("c_custkey",
                    X.fill_missing(F.nullif("c_mktsegment", F.lit("HOUSEHOLD")), "").alias("segment"),
                    X.fill_missing(F.nullif("c_nationkey", F.lit(0)), 0).alias("nation"))


def q_rename_first_drop_range(spark, sf):
    li = _src(spark, sf, "lineitem")["lineitem"]
    return P.drop_range(P.rename_first(li, "id"), ("l_quantity", "l_tax"))


def q_status_extract(spark, sf):
    return extract_status(_src(spark, sf, "orders")["orders"], "o_orderstatus", "F")


# ----------------------------------------------------------- sources -------

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])


def _hard_name() -> Column:
    """Names as exports hold them: quotes, a backslash before the quote, the
    separator, two quotes in a row."""
    name, kind = F.col("c_name"), F.col("c_custkey") % 5
    return (F.when(kind == 0, F.concat(F.lit('The "Best" '), name)).when(kind == 1, F.concat(name, F.lit("\\")))
            .when(kind == 2, F.concat(name, F.lit("\tShop, Ltd"))).when(kind == 3, F.concat(name, F.lit('""')))
            .otherwise(name))


def _hard_names(customer: DataFrame) -> DataFrame:
    return customer.withColumn("c_name", _hard_name())


HARD_NAME_SQL = """CASE c_custkey % 5 WHEN 0 THEN 'The "Best" ' || c_name WHEN 1 THEN c_name || chr(92)
            WHEN 2 THEN c_name || chr(9) || 'Shop, Ltd' WHEN 3 THEN c_name || '""' ELSE c_name END"""
BROKEN_NAME_SQL = f"""CASE c_custkey % 12 WHEN 1 THEN c_name || chr(10) || 'Branch 2'
            WHEN 5 THEN '"A"' || chr(10) || chr(10) || c_name WHEN 9 THEN c_name || chr(10) || '"' || chr(9) || chr(10)
            ELSE {HARD_NAME_SQL} END"""


def _pack_archives(member: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per batch: one zip export holding ``member`` as a tab file, named by
    its place, so that a repeated task writes the same archive."""
    def run(batches):
        from pyspark import TaskContext

        for number, pdf in enumerate(batches):
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
                zf.writestr(member, pdf.to_csv(sep="\t", index=False, na_rep="NA"))
                zf.writestr("other.tab", "id\n1\n")
            name = f"export-{TaskContext.get().partitionId()}-{number}.zip"
            yield pd.DataFrame({"path": [name], "content": [buf.getvalue()]})
    return run


def _broken_names(customer: DataFrame) -> DataFrame:
    """The same with line breaks in every fourth name: several in a row, behind a quote, before the closing quote."""
    name, kind = F.col("c_name"), F.col("c_custkey") % 12
    broken = (F.when(kind == 1, F.concat(name, F.lit("\nBranch 2"))).when(kind == 5, F.concat(F.lit('"A"\n\n'), name))
              .when(kind == 9, F.concat(name, F.lit('\n"\t\n'))))
    return customer.withColumn("c_name", F.coalesce(broken, _hard_name()))


def _stored_blocks(spark: SparkSession, archives: DataFrame, member: str, block_lines: int) -> DataFrame:
    """A member's lines staged in the raw layer, as the batch run does."""
    root = f"{checkpoint_root(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    write_layer(with_quote_state(explode_blocks(archives, [member], block_lines)), root, "raw", "_export_lines")
    return read_layer(spark, root, "raw", "_export_lines")


def q_zip_members(spark, sf):
    """S1 round trip: each batch of ``customer`` becomes one zip export (plus
    an unrelated member), the archive scan reads the member back.  Blocks are
    short, so that many records with line breaks lie in two or more of them."""
    c = _broken_names(_src(spark, sf, "customer")["customer"])
    archives = c.mapInPandas(_pack_archives("customer.tab"), "path string, content binary")
    # a small file is one task, but many archives
    archives = archives.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = _stored_blocks(spark, archives, "customer.tab", block_lines=64)
    return read_member(records(blocks), "customer.tab", CUSTOMER_SCHEMA, check_header=False).drop("archive", "line_no")


ACTION_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("originator", T.StringType()),
    T.StructField("responsible__name", T.StringType()), T.StructField("date", T.DateType()),
])
#: Rows of the action log in one archive.
ARCHIVE_ROWS = 5000


def _pack_actions(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One archive of the action log (at most ``ARCHIVE_ROWS`` rows)."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        log = rows.sort_values("event_id").drop(columns=["number", "event_id"])
        zf.writestr("interview__actions.tab", log.to_csv(sep="\t", index=False, na_rep="NA"))
    return pd.DataFrame({"path": [f"export-{key[0]:012d}.zip"], "content": [buf.getvalue()]})


def q_first_action_in_archives(spark, sf):
    """A7 over several archives: the log lies in archives whose order is not
    that of its dates; the first action goes by the number of its record over
    all archives."""
    e = _src(spark, sf, "events")["events"]
    log = e.select((F.lit(999_999_999) - F.floor(F.col("event_id") / ARCHIVE_ROWS)).cast("long").alias("number"), "event_id",
                   F.col("user_id").alias("id"), F.col("event_type").alias("originator"),
                   F.concat_ws("\n", "event_type", F.when(F.col("event_id") % 7 == 0, F.lit("second line"))).alias("responsible__name"),
                   F.to_date("ts").alias("date"))
    archives = log.groupBy("number").applyInPandas(_pack_actions, "path string, content binary")
    blocks = _stored_blocks(spark, archives, "interview__actions.tab", block_lines=256)
    lines = number_records(records(blocks), blocks)
    actions = read_member(lines, "interview__actions.tab", ACTION_SCHEMA, check_header=False).drop("archive")
    return quality.first_action({"interview_actions": actions})


def q_code_list_catalog(spark, sf):
    """S3: lists land as CSV files in the shared folder, the catalog types the
    codes, and the lists are stored as tables (K1) and read back.  One label
    is ``NA``: only an empty cell is missing."""
    s = _src(spark, sf, "nation", "region")
    root = f"{checkpoint_root(spark).rstrip('/')}/code-lists-{uuid.uuid4().hex}"
    s["nation"].select(F.col("n_nationkey").alias("area_council"),
                       F.col("n_name").alias("area_council_desc")) \
        .write.option("header", True).csv(f"{root}/area_council.csv")
    s["region"].select(F.col("r_regionkey").alias("province"),
                       F.when(F.col("r_regionkey") == 0, "NA").otherwise(F.col("r_name")).alias("province_desc")) \
        .write.option("header", True).csv(f"{root}/province.csv")
    lists = load_code_lists(spark, root, ["area_council", "province"])
    lists = {name: read_layer(spark, root, "raw", name) for name in store_code_lists(lists, root)}
    return (lists["area_council"].select(F.lit("area_council").alias("list_name"),
                                         F.col("area_council").alias("code"),
                                         F.col("area_council_desc").alias("label"))
            .unionByName(lists["province"].select(F.lit("province").alias("list_name"),
                                                  F.col("province").alias("code"),
                                                  F.col("province_desc").alias("label"))))


def q_delimited_round_trip(spark, sf):
    """``customer`` is written as a tab-delimited export with a header and
    ``NA`` for missing values (in the shared folder), then read back with its
    declared schema."""
    c = _hard_names(_src(spark, sf, "customer")["customer"])
    path = f"{checkpoint_root(spark).rstrip('/')}/tab-export-{uuid.uuid4().hex}"
    (c.select("c_custkey", "c_name", F.nullif("c_nationkey", F.lit(0)).alias("c_nationkey"),
              "c_acctbal", "c_mktsegment")
     .write.option("sep", "\t").option("header", True).option("nullValue", "NA").option("escape", '"').csv(path))
    return read_delimited(spark, path, CUSTOMER_SCHEMA)


def q_guessed_types(spark, sf):
    """``orders`` as a tab-delimited text export, every column read as
    text, types guessed over all rows: codes with leading zeros and a number
    column with one odd value stay text."""
    o = _src(spark, sf, "orders")["orders"]
    key = F.col("o_orderkey")
    rows = o.select(
        key.cast("string").alias("key"), F.when(key % 5 != 0, F.col("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
        F.when(key % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd")).alias("moment"),
        F.when(F.col("o_totalprice") > 100000, "TRUE").otherwise("F").alias("large"),
        F.lpad((key % 1000).cast("string"), 4, "0").alias("code"),
        F.when(key == 1, "1d").otherwise((key % 7).cast("string")).alias("odd"),
        F.lit(None).cast("string").alias("nothing"), "o_orderpriority")
    path = f"{checkpoint_root(spark).rstrip('/')}/text-export-{uuid.uuid4().hex}"
    rows.write.option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in rows.columns])
    return read_guessed(read_delimited(spark, path, text))


def q_comma_csv_list(spark, sf):
    """The province list as a comma CSV file (labels hold commas, quotes
    and an ``NA`` that is missing), read with its declared schema."""
    r = _src(spark, sf, "region")["region"]
    path = f"{checkpoint_root(spark).rstrip('/')}/comma-list-{uuid.uuid4().hex}"
    label = F.when(F.col("r_regionkey") != 2, F.concat(F.lit('"'), "r_name", F.lit('", north')))
    (r.select(F.col("r_regionkey").alias("province"), label.alias("province_desc"))
     .write.option("header", True).option("nullValue", "NA").option("escape", '"').csv(path))
    schema = T.StructType([T.StructField("province", T.DoubleType()), T.StructField("province_desc", T.StringType())])
    return read_delimited(spark, path, schema, sep=",")


def q_layer_round_trip(spark, sf):
    """K1/K2: ``orders`` stored in the raw layer, read back, cleaned and
    stored one layer up; stored twice, so the second write replaces the first."""
    root = f"{checkpoint_root(spark).rstrip('/')}/layers-{uuid.uuid4().hex}"
    o = _src(spark, sf, "orders")["orders"]
    write_layer(o.where(F.col("o_orderstatus") == "F"), root, "raw", "orders")
    write_layer(o, root, "raw", "orders")
    raw = P.rename_first(read_layer(spark, root, "raw", "orders"), "id")
    write_layer(P.to_integer(raw, ["o_totalprice"]), root, "clean", "orders")
    return read_layer(spark, root, "clean", "orders")


def q_orders_csv_lines(spark, sf):
    """K3 on a numeric table: R ``write.csv`` lines of ``orders`` (text
    quoted, numbers and date-times bare, R's number text)."""
    o = _src(spark, sf, "orders")["orders"]
    return quoted_csv_lines(o.select("o_orderkey", "o_orderstatus", "o_totalprice",
                                     "o_orderdate", "o_orderpriority"))


def q_distinct_totals(spark, sf):
    """A2 with A10: distinct establishments by industry and year, with totals."""
    t = _t(spark, sf)
    numbers = G.dense_numbers(t["main"], "id", "number")
    rows = reports.industry_years(t, _ind(t)).join(numbers, "id")
    return G.distinct_totals(rows, "Industry", "Reference_Year", "number", "establishments")


def q_chosen_time_forms(spark, sf):
    """The log's moments in four written forms, each column's form found
    from its values; a few values of another form are missing."""
    e = _src(spark, sf, "events")["events"]
    ts, odd = F.col("ts"), F.col("event_id") % 11 == 0
    text = e.select(
        "event_id",
        F.when(odd, "no time").otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).alias("iso"),
        F.when(odd, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(ts, "MM/dd/yyyy hh:mm:ss a")).alias("clock"),
        F.date_format(ts, "d.M.yy H:m:s").alias("short"), F.date_format(ts, "d MMMM yyyy HH:mm:ss").alias("name"))
    return X.parse_times(text, ["iso", "clock", "short", "name"])


def q_csv_parts(spark, sf):
    """K3: ``orders`` published as one ordered document in parts; the lines
    read back through the manifest, with the byte each part begins at."""
    o = _src(spark, sf, "orders")["orders"].select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = f"{checkpoint_root(spark).rstrip('/')}/orders-{uuid.uuid4().hex}.csv"
    write_quoted_csv(spark, o, path, sort_by=["o_orderkey"])
    parts = read_manifest(spark, path)
    lines = spark.read.text(path).select("value", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("part"))
    sizes = lines.groupBy("part").agg(F.sum(F.octet_length("value") + 1).cast("long").alias("read"), F.count(F.lit(1)).alias("n"))
    same = parts.join(sizes, "part").agg(F.bool_and(F.col("bytes") == F.col("read")).alias("whole"),
                                         F.sum("bytes").alias("bytes"), F.sum("n").alias("lines"))
    return same


QUERIES: dict[str, Query] = {
    "label_join": q_label_join,
    "mixed_type_label_join": q_mixed_type_label_join,
    "unmatched_codes": q_unmatched_codes,
    "star_labels": q_star_labels,
    "roster_fanout": q_roster_fanout,
    "exists_join": q_exists_join,
    "merge_null_keys": q_merge_null_keys,
    "merge_suffixes": q_merge_suffixes,
    "merge_heavy_keys": q_merge_heavy_keys,
    "code_combinations": q_code_combinations,
    "positive_code_count": q_positive_code_count,
    "errors_by_variable": q_errors_by_variable,
    "errors_by_interview": q_errors_by_interview,
    "first_action": q_first_action,
    "interviewer_errors": q_interviewer_errors,
    "errors_by_originator": q_errors_by_originator,
    "sector_union": q_sector_union,
    "fieldwork_monitor": q_fieldwork_monitor,
    "fieldwork_industry": q_fieldwork_industry,
    "fieldwork_export_lines": q_fieldwork_export_lines,
    "establishments_by_industry_year": q_establishments_by_industry_year,
    "size_by_industry": q_size_by_industry,
    "legal_status_in_year": q_legal_status_in_year,
    "sales_by_industry": q_sales_by_industry,
    "employees_in_year": q_employees_in_year,
    "compensation_in_year": q_compensation_in_year,
    "skills_all_years": q_skills_all_years,
    "pilot_extract": q_pilot_extract,
    "legal_status_by_year": q_legal_status_by_year,
    "size_by_industry_by_year": q_size_by_industry_by_year,
    "sales_by_industry_by_year": q_sales_by_industry_by_year,
    "size_totals_by_year": q_size_totals_by_year,
    "sales_totals_by_year": q_sales_totals_by_year,
    "employee_totals_by_year": q_employee_totals_by_year,
    "skill_totals_by_year": q_skill_totals_by_year,
    "industry_year_crosstab": q_industry_year_crosstab,
    "industry_year_totals": q_industry_year_totals,
    "table_1_pivot": q_table_1_pivot,
    "distinct_totals": q_distinct_totals,
    "fieldwork_durations": q_fieldwork_durations,
    "cast_integer": q_cast_integer,
    "to_integer_columns": q_to_integer_columns,
    "category_text": q_category_text,
    "epoch_day_to_date": q_epoch_day_to_date,
    "paste_missing": q_paste_missing,
    "clean_time_text": q_clean_time_text,
    "minutes_between": q_minutes_between,
    "chosen_time_forms": q_chosen_time_forms,
    "fill_missing": q_fill_missing,
    "rename_first_drop_range": q_rename_first_drop_range,
    "status_extract": q_status_extract,
    "zip_members": q_zip_members,
    "first_action_in_archives": q_first_action_in_archives,
    "delimited_round_trip": q_delimited_round_trip,
    "orders_csv_lines": q_orders_csv_lines,
    "csv_parts": q_csv_parts,
    "code_list_catalog": q_code_list_catalog,
    "guessed_types": q_guessed_types,
    "comma_csv_list": q_comma_csv_list,
    "layer_round_trip": q_layer_round_trip,
}
