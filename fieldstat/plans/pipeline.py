"""The census batch run, end to end (entry points 1 and 3 of the reference).

    export archives --S1--> raw layer --clean--> clean layer --marts/reports--> mart layer
                                                       code lists (S3) --^        \\--> fieldwork CSV (K3)

Each layer is written once per run and read back by the next step, so no
step overwrites what it reads (K2) and every later step restarts from files
in the shared warehouse folder, not from a long lineage, if an executor is
lost.  Only the archive scan runs Python (inside tasks); everything else is
DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstat.functions.columns import number
from fieldstat.operators.groups import crosstab_count, crosstab_totals, pivot_values
from fieldstat.operators.reshape import drop_range, rename_first, to_category, to_integer
from fieldstat.plans import marts, quality, reports
from fieldstat.sinks.layers import read_layer, store_code_lists, write_layer
from fieldstat.sinks.quoted_csv import write_quoted_csv
from fieldstat.sources.archive import archive_blocks, archive_headers, check_headers, read_member
from fieldstat.sources.codelists import CODE_LISTS, load_code_lists
from fieldstat.sources.records import number_records, records, with_quote_state
from fieldstat.sources.types import read_guessed

# Export members and the table each becomes, in export order.
EXPORT_MEMBERS = {
    "business_census2022.tab": "main",
    "capital_goods.tab": "capital_goods",
    "exp_details.tab": "exp_details",
    "exp_range.tab": "exp_range",
    "finaAcess_roser.tab": "finaAcess_roser",
    "info_activities.tab": "info_activities",
    "info_other_business.tab": "info_other_business",
    "mobMoney_info.tab": "mobMoney_info",
    "other_cost.tab": "other_cost",
    "other_invest.tab": "other_invest",
    "ref_yearDetails.tab": "ref_yearDetails",
    "register_id.tab": "register_id",
    "interview__errors.tab": "errors",
    "interview__actions.tab": "interview_actions",
}

# Column ranges dropped from main and ref_yearDetails.
MAIN_DROP_RANGES = (
    ("busiName_other__0", "busiName_other__14"),
    ("bus_activities__1", "bus_activities__21"),
    ("hhld_exp__1", "hhld_exp__7"),
    ("finance_source__1", "finance_source__7"),
    ("mobile_money_service__1", "mobile_money_service__4"),
)
REF_YEAR_DROP_RANGES = (("utilities_exp__1", "utilities_exp__7"),)

# main's categorical columns, in the reference's order.  The four
# GPS measures at the end of the reference's list stay numeric here (no report
# uses them as categories).
MAIN_CATEGORIES = (
    "ref_letter", "ref_number", "second_number", "email", "owner_sex", "owner_character",
    "second_email", "postal", "employee_sex", "position", "registered", "ynRegistered",
    "head_office", "otherUnits_acc", "province", "island", "area_council", "permit_number",
    "legal_status", "place_of_operation", "account_keeping", "major_label_vansic",
    "sub_major_label_vansic", "minor_label_vansic", "unit_label_vansic",
    "vnsic_label_infovansic", "imp_brdclose", "imp_finstatus", "imp_situation__1",
    "imp_situation__2", "imp_situation__3", "imp_situation__4", "imp_situation__5",
    "overcome_problem__1", "overcome_problem__2", "overcome_problem__3", "overcome_problem__4",
    "overcome_problem__5", "overcome_problem__6", "overcome_problem__7", "overcome_problem__8",
    "business_operate", "operation_Noexp__1", "operation_Noexp__2", "operation_Noexp__3",
    "operation_Noexp__4", "operation_Noexp__5", "same_business", "informal__1",
    "informal__2", "informal__3", "informal__4", "informal__5",
    "major_Infolabel_vanisic", "sub_majorlabel_info_vanisic", "minor_label_infovansic",
    "unit_label_infovansic", "vansic_label_infovansic", "infor_paidEmp", "unpaid_emp",
    "hhld_business", "excess_exp", "business_develop", "business_suceed", "assisst_bank",
    "gov_assist", "bank_services", "bank_regUses", "aware_bankService", "info_bank",
    "insurance", "insurance_poilcy", "insurance_noPolicy",
)
GPS_COLUMNS = ("g4_business_gps__Accuracy", "g4_business_gps__Altitude",
               "g4_business_gps__Latitude", "g4_business_gps__Longitude")

# Integer columns per table, in the reference's order.
INTEGER_COLUMNS = {
    "main": ("age", "day_of_birth", "business_locate", "male_inforEmp", "female_inforEmp",
             "paid_empTot", "hrs_unpaidMale", "unpaid_Maleemp", "unpaid_Fememp",
             "unpaid_empSize", "hrs_unpaidFemale", "average_hrs"),
    "exp_range": ("exp_utilities",),
    "exp_details": ("utilities_cost",),
    "ref_yearDetails": (
        "wage_bill", "income_resale", "cost_resale", "income", "expense", "tot_paid_emp",
        "sales_goods_services", "local_emp", "foreign_emp", "employee_comp", "mang_vanmale",
        "skill_vanmale", "unskil_vanmale", "mang_vanfemale", "skill_vanfemale",
        "unskil_vanfemale", "mang_formale", "skill_formale", "unskil_formale",
        "mang_forfemale", "skill_forfemale", "unskil_forfemale", "transport_cost",
        "equip_cost", "contract_opt", "contract_cost", "capital_exp", "cost_construct",
        "capital_inc", "inc_construct", "rent_recieved", "rent_paid", "interest_recieved",
        "interest_paid", "subsidy", "tax_paid"),
    "other_cost": ("cost_otherExp",),
    "other_invest": ("cost_otherInvest",),
    "capital_goods": ("cost_otherCapital",),
}


def land_raw(spark: SparkSession, archive_dir: str, root: str,
             schemas: Mapping[str, T.StructType] | None = None,
             members: Mapping[str, str] = EXPORT_MEMBERS,
             partition_by: Mapping[str, list[str]] | None = None) -> dict[str, str]:
    """S1 + P1 + K1: every export member to the raw layer, first column
    renamed to ``id``.  Without a declared schema a member is landed as text
    (column names from its header); typing happens in the clean step.
    ``partition_by`` names partition columns per table (for example the
    interview status, so that the S6 extract prunes folders)."""
    schemas = schemas or {}
    # one cheap pass for all headers (one line per member and archive)
    headers = archive_headers(spark, archive_dir, members=list(members)).cache()
    # one pass through the archives for all members' blocks of lines, staged as
    # Parquet partitioned by member; each member is then cut into records and
    # parsed from its own folder (partition pruning) instead of decompressing
    # the export once per member
    blocks = with_quote_state(archive_blocks(spark, archive_dir, members=list(members)))
    write_layer(blocks, root, "raw", "_export_lines", partition_by=["member"])
    blocks = read_layer(spark, root, "raw", "_export_lines")
    lines = number_records(records(blocks), blocks)
    paths = {}
    read_as = _text_schemas(headers, [m for m, table in members.items() if table not in schemas])
    read_as |= {m: schemas[table] for m, table in members.items() if table in schemas}
    check_headers(headers, {m: schema.fieldNames() for m, schema in read_as.items()})
    for member, table in members.items():
        schema = read_as[member]
        df = read_member(lines, member, schema, check_header=False).drop("archive")
        paths[table] = write_layer(rename_first(df, "id"), root, "raw", table,
                                   (partition_by or {}).get(table))
    headers.unpersist()
    return paths


def _text_schemas(headers: DataFrame, members: list[str]) -> dict[str, T.StructType]:
    """All-text schemas from the members' header lines (one line per member)."""
    heads = {r["member"]: r["line"] for r in headers.where(F.col("member").isin(members))
             .groupBy("member").agg(F.min("line").alias("line")).collect()}
    for member in members:
        if member not in heads:
            raise FileNotFoundError(f"member {member!r} not found in any archive")
    return {m: T.StructType([T.StructField(n.strip('"'), T.StringType()) for n in line.split("\t")])
            for m, line in heads.items()}


def guess_rest(raw: Mapping[str, DataFrame], declared: Iterable[str] = ()) -> dict[str, DataFrame]:
    """Columns of undeclared tables that no cast list names, read as the
    types their values have (one aggregate per table).  The key ``id`` stays
    text in every table, so that tables keep joining by it."""
    out = dict(raw)
    for table in set(raw) - set(declared):
        listed = {"id", *INTEGER_COLUMNS.get(table, ()), *(MAIN_CATEGORIES + GPS_COLUMNS if table == "main" else ())}
        out[table] = read_guessed(raw[table], [c for c in raw[table].columns if c not in listed])
    return out


def clean_tables(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """P2 + P7: the reference's cleaning, as one projection per table."""
    out = dict(raw)
    main = drop_range(raw["main"], *MAIN_DROP_RANGES)
    main = to_category(main, MAIN_CATEGORIES)
    main = main.withColumns({c: number(c) for c in GPS_COLUMNS})
    out["main"] = to_integer(main, INTEGER_COLUMNS["main"])
    ry = drop_range(raw["ref_yearDetails"], *REF_YEAR_DROP_RANGES)
    out["ref_yearDetails"] = to_integer(ry, INTEGER_COLUMNS["ref_yearDetails"])
    for table in ("exp_range", "exp_details", "other_cost", "other_invest", "capital_goods"):
        out[table] = to_integer(raw[table], INTEGER_COLUMNS[table])
    acts = raw["interview_actions"]
    if dict(acts.dtypes).get("date") == "string":
        acts = acts.withColumn("date", F.try_to_date("date"))
    out["interview_actions"] = acts
    return out


def shared_rows(t: Mapping[str, DataFrame], ind: DataFrame) -> dict[str, DataFrame]:
    """Row sets each shared by a pair of report tables (2/5, 3/4, 6/7, 8/9):
    materialised once, they halve the passes over the roster."""
    return {
        "size_sales": reports.size_sales_rows(t, ind),
        "legal_status": reports.legal_status_rows(t, ind),
        "employees": reports.employee_rows(t, ind),
        "compensation": reports.compensation_rows(t, ind),
    }


def build_marts(t: Mapping[str, DataFrame], ind: DataFrame | None = None,
                fwm: DataFrame | None = None,
                rows: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every derived dataset of the script (R1-R18), lazily, by table name.
    ``ind``/``fwm`` and the ``shared_rows`` may be passed in already
    materialised (see ``run``)."""
    ind = ind if ind is not None else marts.industry(t)
    fwm = fwm if fwm is not None else marts.fieldwork_monitor(t)
    rows = rows if rows is not None else shared_rows(t, ind)
    return {
        "fwm": fwm,
        "Formal_Industry": marts.formal_industry(t),
        "Informal_Industry": marts.informal_industry(t),
        "Industry": ind,
        "fwm_industry": marts.fieldwork_industry(t, fwm, ind),
        "Table_1": reports.establishments_by_industry_year(t, ind),
        "Table_2": reports.size_by_industry(t, ind, rows=rows["size_sales"]),
        "Table_3": reports.legal_status_in_year(t, ind, "2019", rows=rows["legal_status"]),
        "Table_4": reports.legal_status_in_year(t, ind, "2021", rows=rows["legal_status"]),
        "Table_5": reports.sales_by_industry(t, ind, rows=rows["size_sales"]),
        "Table_6": reports.employees_in_year(t, ind, "2019", rows=rows["employees"]),
        "Table_7": reports.employees_in_year(t, ind, "2021", rows=rows["employees"]),
        "Table_8": reports.compensation_in_year(t, ind, "2019", rows=rows["compensation"]),
        "Table_9": reports.compensation_in_year(t, ind, "2021", rows=rows["compensation"]),
        "Table_10": reports.skills_all_years(t, ind),
        "pilotData": reports.pilot_extract(t),
        "prov_results": quality.interviews_per_province(t),
        "errors_detect": quality.errors_by_variable(t),
    }


def build_pivots(t: Mapping[str, DataFrame], table_1: DataFrame) -> dict[str, DataFrame]:
    """A9/A10, disabled in the reference: the pivot of Table_1 with
    Industry rows, Reference_Year columns and ``n()`` cells, and its totals.
    The columns are the labels of the reference-year list."""
    years = pivot_values(t["reference_year"], "reference_year_desc")
    return {
        "Table_1_pivot": crosstab_count(table_1, "Industry", "Reference_Year", years),
        "Table_1_pivot_totals": crosstab_totals(table_1, "Industry", "Reference_Year"),
    }


def build_dashboard(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The three dashboard chart datasets."""
    return {
        "chart_errors_by_originator": quality.errors_by_originator(t),
        "chart_errors_by_variable": quality.errors_by_variable(t),
        "chart_interviews_per_province": quality.interviews_per_province(t),
    }


def run(spark: SparkSession, archive_dir: str, codes_dir: str, root: str,
        csv_path: str | None = None, schemas: Mapping[str, T.StructType] | None = None,
        code_format: str = "csv", id_buckets: int | None = None) -> dict[str, str]:
    """The whole script: land, clean, load lists, write every mart and report,
    export the fieldwork CSV.  Returns the written paths by name.

    ``id_buckets`` writes every clean table, and the reused ``Industry`` and
    ``fwm`` marts, bucketed on ``id`` into that many buckets (size it like the
    shuffle partitions of the largest roster): the reports then join them and
    choose rows per establishment without shuffling them.
    """
    written = dict(land_raw(spark, archive_dir, root, schemas))
    raw = {name: read_layer(spark, root, "raw", name) for name in EXPORT_MEMBERS.values()}
    bucket = {"bucket_by": ["id"], "buckets": id_buckets} if id_buckets else {}
    for name, df in clean_tables(guess_rest(raw, schemas or {})).items():
        written[f"clean.{name}"] = write_layer(df, root, "clean", name, **bucket)
    t: dict[str, DataFrame] = {name: read_layer(spark, root, "clean", name)
                               for name in EXPORT_MEMBERS.values()}
    lists = load_code_lists(spark, codes_dir, CODE_LISTS, fmt=code_format)
    written |= {f"list.{name}": path for name, path in store_code_lists(lists, root).items()}
    t.update(lists)
    # the two results every later dataset reuses are written first and read
    # back, as the reference stores them: computed once, short lineage after
    for name, df in (("Industry", marts.industry(t)), ("fwm", marts.fieldwork_monitor(t))):
        written[f"mart.{name}"] = write_layer(df, root, "mart", name, **bucket)
    ind, fwm = read_layer(spark, root, "mart", "Industry"), read_layer(spark, root, "mart", "fwm")
    rows = {}
    for name, df in shared_rows(t, ind).items():
        written[f"mart._rows_{name}"] = write_layer(df, root, "mart", f"_rows_{name}")
        rows[name] = read_layer(spark, root, "mart", f"_rows_{name}")
    for name, df in {**build_marts(t, ind, fwm, rows), **build_dashboard(t)}.items():
        if name not in ("Industry", "fwm"):
            written[f"mart.{name}"] = write_layer(df, root, "mart", name)
    table_1 = read_layer(spark, root, "mart", "Table_1")
    for name, df in build_pivots(t, table_1).items():
        written[f"mart.{name}"] = write_layer(df, root, "mart", name)
    if csv_path:
        fwi = read_layer(spark, root, "mart", "fwm_industry")
        written["fieldwork.csv"] = write_quoted_csv(spark, fwi, csv_path,
                                                    sort_by=["id", "IndustryType"])
    return written


def dashboard(spark: SparkSession, codes_dir: str, root: str,
              code_format: str = "csv") -> dict[str, str]:
    """Entry point 3 on its own: the three chart datasets from the clean
    layer of an earlier run (no re-landing, unlike the reference's
    dashboard, which reloads and re-stores the raw export)."""
    t: dict[str, DataFrame] = {name: read_layer(spark, root, "clean", name)
                               for name in ("main", "errors", "interview_actions")}
    t.update(load_code_lists(spark, codes_dir, ["province"], fmt=code_format))
    return {f"mart.{name}": write_layer(df, root, "mart", name)
            for name, df in build_dashboard(t).items()}


def main(argv: list[str] | None = None) -> None:
    """``python -m fieldstat.plans.pipeline --archives DIR --codes DIR --root DIR``.

    Uses the session the environment configures (``spark-submit`` settings,
    ``spark.checkpoint.dir``); it only sets an application name.
    """
    import argparse
    import json

    p = argparse.ArgumentParser(description="Census batch run: land, clean, marts, reports, CSV.")
    p.add_argument("--archives", help="folder with the zip exports (not for --dashboard-only)")
    p.add_argument("--codes", required=True, help="folder with one file per code list")
    p.add_argument("--root", required=True, help="shared warehouse folder for the layers")
    p.add_argument("--csv", help="folder for the fieldwork CSV export")
    p.add_argument("--code-format", default="csv", help="code list file format (csv, parquet)")
    p.add_argument("--id-buckets", type=int, help="bucket the clean layer on id")
    p.add_argument("--dashboard-only", action="store_true",
                   help="only the chart datasets, from the clean layer of an earlier run")
    a = p.parse_args(argv)
    if not a.dashboard_only and not a.archives:
        p.error("--archives is required unless --dashboard-only is given")
    spark = SparkSession.builder.appName("fieldstat-census").getOrCreate()
    if a.dashboard_only:
        written = dashboard(spark, a.codes, a.root, code_format=a.code_format)
    else:
        written = run(spark, a.archives, a.codes, a.root, csv_path=a.csv,
                      code_format=a.code_format, id_buckets=a.id_buckets)
    print(json.dumps(written, indent=2))


if __name__ == "__main__":
    main()
