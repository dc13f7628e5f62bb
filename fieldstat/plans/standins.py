"""Census tables built from the driver's TPC-H-style tables.

The reference's inputs (the survey export and the code-list workbook) are
not public, so the registered queries run the census plans on stand-ins

=====================  ==================================================
census table           derived from
=====================  ==================================================
main                   customer (+ the customer's region through nation)
ref_yearDetails        orders (one row per order: several per id and year);
                       with ``measures=True`` lineitem joined through orders
register_id            orders (first character of the priority as code)
interview_actions      events
errors                 events of type ``error``
area_council, ...      nation (code n_nationkey, label n_name)
province, ...          region (code r_regionkey, label r_name)
reference_year         distinct order years
enumerators            distinct event types
=====================  ==================================================

Codes are stored as text in ``main`` and the rosters, like the reference's
database, while the lists keep numeric codes: every label join is the
mixed-type join J4.  ``STANDIN_SQL`` holds the same definitions for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstat.functions.columns import as_integer, label_in
from fieldstat.operators.joins import exists_join, guarded_broadcast
from fieldstat.operators.reshape import to_category
from fieldstat.plans.reports import SKILL_MEASURES

TABLES = ("region", "nation", "customer", "orders", "lineitem", "events", "part")


class LazyTables(dict):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self._builders = builders

    def __missing__(self, name: str) -> DataFrame:
        self[name] = table = self._builders[name]()
        return table


def read_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return LazyTables({n: lambda n=n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names})


# main's code columns stored as category text.
MAIN_CATEGORIES = ("interview__status", "ref_letter", "ref_number", "major_label_vansic",
                   "major_Infolabel_vanisic", "province", "area_council", "legal_status",
                   "account_keeping")
def main_table(src: dict[str, DataFrame]) -> DataFrame:
    c, n = src["customer"], src["nation"]
    nat = n.select("n_nationkey", "n_regionkey")
    raw = c.join(nat, c.c_nationkey == nat.n_nationkey).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name_businesEsta"),
        F.col("n_regionkey").alias("interview__status"),
        F.col("c_nationkey").alias("ref_letter"),
        F.col("c_custkey").alias("ref_number"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_nationkey")).alias("major_label_vansic"),
        F.when(F.col("c_acctbal") < 5000, F.col("c_nationkey")).alias("major_Infolabel_vanisic"),
        F.col("n_regionkey").alias("province"),
        F.col("c_nationkey").alias("area_council"),
        F.col("n_regionkey").alias("legal_status"),
        F.col("n_regionkey").alias("account_keeping"),
        F.col("c_mktsegment").alias("infor_paidEmp"),
        F.col("c_acctbal").alias("busines_start_for"),
        F.col("c_nationkey").alias("business_locate"),
        _interview_time(F.col("c_custkey") % 10_000).alias("start_time"),
        _interview_time(F.col("c_custkey") % 10_000 + 17 + F.col("c_nationkey")).alias("start_end_time"),
    )
    return to_category(raw, MAIN_CATEGORIES)


def _interview_time(minutes) -> Column:
    """ISO text of a moment so many minutes after the first interview."""
    first = F.lit("2022-07-01 08:00:00").cast("timestamp_ntz")
    return F.date_format(first + F.make_dt_interval(mins=minutes), "yyyy-MM-dd'T'HH:mm:ss")


def ref_year_details(src: dict[str, DataFrame], measures: bool = False,
                     years: Iterable[str] | None = None, year_list: DataFrame | None = None) -> DataFrame:
    """``years`` cuts the orders to those years (through the year list, like
    the reports) before they meet ``lineitem``: what a report drops by its
    year is not shuffled by the order key."""
    o = src["orders"].select("o_orderkey", F.col("o_custkey").alias("id"),
                             F.year("o_orderdate").cast("string").alias("ref_yearDetails__id"), "o_totalprice")
    paid = F.nullif(as_integer(F.col("o_totalprice") / 50000, text=False), F.lit(0)).alias("tot_paid_emp")
    sales = as_integer("o_totalprice", text=False).alias("sales_goods_services")
    if not measures:
        return o.select("id", "ref_yearDetails__id", paid, sales)
    if years is not None:
        wanted = year_list.where(label_in("reference_year_desc", list(years)))
        o = exists_join(o, wanted.select(F.col("reference_year").cast("string").alias("ref_yearDetails__id")),
                        "ref_yearDetails__id")
    li = src["lineitem"]
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        "id", "ref_yearDetails__id", paid, sales,
        as_integer("l_quantity", text=False).alias("local_emp"),
        F.col("l_linenumber").alias("foreign_emp"),
        as_integer("l_extendedprice", text=False).alias("employee_comp"),
        *[as_integer(F.col("l_extendedprice") / (100 * (k + 1)), text=False).alias(name)
          for k, name in enumerate(SKILL_MEASURES)])


def code_list(df: DataFrame, code: str, label: str, name: str) -> DataFrame:
    return df.select(F.col(code).alias(name), F.col(label).alias(f"{name}_desc"))


def census_tables(spark: SparkSession, sf_dir: str, measures: bool = False,
                  years: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The census tables of one data folder, read anew by every call and only
    where a plan asks for them.

    Nothing is kept between calls, so replaced data is seen at once.  The
    lists read from files (nation, region) carry Spark's own file sizes, which
    decide about a broadcast without a job.  The year list is broadcast: its
    rows are distinct years of timestamps, of which there are at most 600,000
    (16 bytes each), whatever the data.  The list of originators has no such
    bound: it is checked where it is computed, without a job of its own.
    """
    src = read_tables(spark, sf_dir)

    def reference_year():
        return F.broadcast(
            src["orders"].select(F.year("o_orderdate").alias("reference_year")).distinct()
            .withColumn("reference_year_desc", F.col("reference_year").cast("string")))

    def enumerators():
        return guarded_broadcast(src["events"].select(F.col("event_type").alias("enum")).distinct()
                                 .withColumn("enumdesc", F.upper("enum")))

    def register_id():
        return src["orders"].select(F.col("o_custkey").alias("id"),
                                    F.substring("o_orderpriority", 1, 1).alias("register_id__id"))

    def interview_actions():
        return src["events"].select(
            F.col("user_id").alias("id"), F.col("event_type").alias("originator"),
            F.col("event_type").alias("responsible__name"), F.to_date("ts").alias("date"),
            F.col("ts").alias("time"), F.col("event_id").alias("line_no"))

    def errors():
        return src["events"].where(F.col("event_type") == "error").select(
            F.col("user_id").alias("id"), F.col("props").alias("variable"))

    tables = LazyTables({
        "main": lambda: main_table(src),
        "ref_yearDetails": lambda: ref_year_details(src, measures, years, tables["reference_year"] if years else None),
        "register_id": register_id,
        "interview_actions": interview_actions,
        "errors": errors,
        "reference_year": reference_year,
        "enumerators": enumerators,
        "ref_letter": lambda: src["nation"].select(F.col("n_nationkey").alias("ref_number"),
                                                   F.col("n_name").alias("ref_number_desc")),
        **{name: lambda name=name: code_list(src["nation"], "n_nationkey", "n_name", name)
           for name in ("area_council", "major_label_vansic", "major_Infolabel_vanisic")},
        **{name: lambda name=name: code_list(src["region"], "r_regionkey", "r_name", name)
           for name in ("province", "interview_status", "legal_status", "account_keeping", "institution_reg")},
    })
    return tables


# ---------------------------------------------------------------------------
# The same stand-ins as DuckDB common table expressions, for the oracle SQL.
# ---------------------------------------------------------------------------

def _num(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


STANDIN_SQL = {
    "main": """main AS (
  SELECT c.c_custkey AS id, c.c_name AS name_businesEsta,
         CAST(n.n_regionkey AS VARCHAR) AS interview__status,
         CAST(c.c_nationkey AS VARCHAR) AS ref_letter,
         CAST(c.c_custkey AS VARCHAR) AS ref_number,
         CASE WHEN c.c_mktsegment <> 'HOUSEHOLD' THEN CAST(c.c_nationkey AS VARCHAR) END AS major_label_vansic,
         CASE WHEN c.c_acctbal < 5000 THEN CAST(c.c_nationkey AS VARCHAR) END AS major_Infolabel_vanisic,
         CAST(n.n_regionkey AS VARCHAR) AS province,
         CAST(c.c_nationkey AS VARCHAR) AS area_council,
         CAST(n.n_regionkey AS VARCHAR) AS legal_status,
         CAST(n.n_regionkey AS VARCHAR) AS account_keeping,
         c.c_mktsegment AS infor_paidEmp, c.c_acctbal AS busines_start_for,
         c.c_nationkey AS business_locate,
         strftime(TIMESTAMP '2022-07-01 08:00:00' + to_minutes(c.c_custkey % 10000), '%Y-%m-%dT%H:%M:%S') AS start_time,
         strftime(TIMESTAMP '2022-07-01 08:00:00' + to_minutes(c.c_custkey % 10000 + 17 + c.c_nationkey),
                  '%Y-%m-%dT%H:%M:%S') AS start_end_time
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "ry": """ry AS (
  SELECT o_custkey AS id, CAST(year(o_orderdate) AS VARCHAR) AS ref_yearDetails__id,
         NULLIF(TRY_CAST(trunc(o_totalprice / 50000) AS INTEGER), 0) AS tot_paid_emp,
         TRY_CAST(trunc(o_totalprice) AS INTEGER) AS sales_goods_services
  FROM orders)""",
    "ry_measures": "ry AS (\n  SELECT o_custkey AS id, CAST(year(o_orderdate) AS VARCHAR) AS ref_yearDetails__id,\n"
                   "         TRY_CAST(trunc(l_quantity) AS INTEGER) AS local_emp,\n"
                   "         l_linenumber AS foreign_emp,\n"
                   "         TRY_CAST(trunc(l_extendedprice) AS INTEGER) AS employee_comp,\n"
                   + ",\n".join(f"         TRY_CAST(trunc(l_extendedprice / {100 * (k + 1)}) AS INTEGER) AS {c}"
                                for k, c in enumerate(SKILL_MEASURES))
                   + "\n  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
    "reference_year": """reference_year AS (
  SELECT DISTINCT year(o_orderdate) AS reference_year,
         CAST(year(o_orderdate) AS VARCHAR) AS reference_year_desc FROM orders)""",
    "industry": f"""industry AS (
  SELECT m.id, m.name_businesEsta, n.n_name AS Industry, 'Formal' AS IndustryType
  FROM main m JOIN nation n ON {_num('m.major_label_vansic')} = CAST(n.n_nationkey AS DOUBLE)
  UNION ALL
  SELECT m.id, m.name_businesEsta, n.n_name AS Industry, 'Informal' AS IndustryType
  FROM main m JOIN nation n ON {_num('m.major_Infolabel_vanisic')} = CAST(n.n_nationkey AS DOUBLE))""",
    "register_id": """register_id AS (
  SELECT o_custkey AS id, substr(o_orderpriority, 1, 1) AS register_id__id FROM orders)""",
    "acts": """acts AS (
  SELECT user_id AS id, event_type AS originator, event_type AS responsible__name,
         CAST(ts AS DATE) AS date, ts AS time, event_id AS line_no FROM events)""",
    "errs": """errs AS (
  SELECT user_id AS id, props AS variable FROM events WHERE event_type = 'error')""",
    "enumerators": """enumerators AS (
  SELECT DISTINCT event_type AS enum, upper(event_type) AS enumdesc FROM events)""",
}


def with_standins(*names: str) -> str:
    return "WITH " + ",\n".join(STANDIN_SQL[n] for n in names) + "\n"
