"""Report tables 1-10 and the pilot extract (inventory R6-R16).

The reference writes these as SQL with bare columns under ``GROUP BY``; here
each one is the same join with the group's row chosen by
``representative_rows`` (A4) and the ``HAVING`` test applied on that row
(A5) or, where the key fixes the tested label, as a filter on the code list
before the join (A6, so it prunes the roster early).

Scale notes that hold for all of them:

* code lists are broadcast behind a size check (``label_join``);
* the roster ``ref_yearDetails`` (many rows per establishment) is reduced to
  its own candidate row per group *before* it is joined and shuffled.  This is
  exact: the group's order is lexicographic over columns that each come from
  one input, and ``main``/``Industry`` are functions of ``id``, so the first
  row of the join is the join of each input's first row;
* joins are on ``id``.  Where a row is chosen per (id, year) first, its
  exchange is by both keys (map tasks ship one candidate row per group), and
  the reduced rows are exchanged once more by ``id`` for the joins.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldstat.functions.columns import label_in
from fieldstat.operators.groups import representative_rows
from fieldstat.operators.joins import exists_join, label_join

Tables = Mapping[str, DataFrame]

# The reference years tested by the report queries.
REPORT_YEARS = ("2019", "2021")


def _years(t: Tables, only: Iterable[str] | None = None) -> DataFrame:
    """``reference_year`` list, optionally cut to some labels (A6 pushdown)."""
    ry = t["reference_year"].select("reference_year", "reference_year_desc")
    if only is not None:
        ry = ry.where(label_in("reference_year_desc", list(only)))
    return ry


def _roster_years(t: Tables, cols: list[str], only=None) -> DataFrame:
    r = t["ref_yearDetails"].select("id", "ref_yearDetails__id", *cols)
    return label_join(r, _years(t, only), "ref_yearDetails__id", "reference_year",
                      {"reference_year_desc": "Reference_Year"})


def _ranked(codes: DataFrame, label: str) -> DataFrame:
    """A code list with the place of each label in label order (``rank``, equal
    for equal labels): whole numbers that compare like the labels, so that a
    least label is a minimum of numbers, which a hash aggregate can keep (of
    text or structs it cannot; Spark would sort).  A list's broadcast hint
    carries over."""
    return codes.withColumn("rank", F.dense_rank().over(Window.orderBy(F.col(label).asc_nulls_first())).cast("long"))


def _label_of(df: DataFrame, rank: str, ranked: DataFrame, label: str, alias: str) -> DataFrame:
    """``df`` with the label of a rank in place of the rank."""
    names = ranked.select(F.col("rank").alias(rank), F.col(label).alias(alias)).distinct()
    return df.join(names, rank).drop(rank)


#: Bits of one rank in a packed order; a code list has fewer rows than 2 to this power.
RANK_BITS = 31
_RANK = (1 << RANK_BITS) - 1


def _sector_labels(t: Tables) -> DataFrame:
    """The labels of both classifications with their ranks."""
    labels = [t[c].select(F.col(f"{c}_desc").alias("label")) for c in ("major_label_vansic", "major_Infolabel_vanisic")]
    return _ranked(labels[0].unionByName(labels[1]).distinct(), "label")


def _with_sector_rank(ind: DataFrame, labels: DataFrame) -> DataFrame:
    """``id`` and ``sector``: IndustryType, then Industry, as one number."""
    names = labels.select(F.col("label").alias("__label"), "rank")
    place = F.shiftleft((F.col("IndustryType") != "Formal").cast("long"), RANK_BITS) + F.col("rank")
    return ind.join(names, F.col("Industry").eqNullSafe(F.col("__label"))).select("id", place.alias("sector"))


def _sector_of(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``df`` with Industry and IndustryType in place of ``sector``."""
    df = df.withColumn("rank", F.col("sector").bitwiseAND(_RANK)).withColumn(
        "IndustryType", F.when(F.shiftright("sector", RANK_BITS) == 0, "Formal").otherwise("Informal")).drop("sector")
    return _label_of(df, "rank", labels, "label", "Industry")


def _first_sector(t: Tables, ind: DataFrame) -> DataFrame:
    """One row per establishment: its first (IndustryType, Industry)."""
    labels = _sector_labels(t)
    return _sector_of(_with_sector_rank(ind, labels).groupBy("id").agg(F.min("sector").alias("sector")), labels)


def establishments_by_industry_year(t: Tables, ind: DataFrame, sort: bool = True) -> DataFrame:
    """R6 ``Table_1``: distinct establishments per (Industry, Reference_Year),
    sorted by Industry; the bare ``Area_Council``/``Province`` are the first
    pair of the group in label order.

    Plan: (id, year) pairs are made distinct map-side; the joins on id and the
    grouping by (Industry, year, id) count an establishment once however often
    its id is repeated.  The pair of labels travels as one number that compares
    like the pair (``_ranked``), so all levels are hash aggregates, and counts
    and least pairs are combined per (Industry, year) map-side before the last,
    small exchange.
    """
    areas = _ranked(t["area_council"], "area_council_desc")
    provinces = _ranked(t["province"], "province_desc")
    m = t["main"].select("id", "area_council", "province")
    m = label_join(m, areas, "area_council", "area_council", {"rank": "__area"})
    m = label_join(m, provinces, "province", "province", {"rank": "__province"})
    m = m.select("id", (F.shiftleft("__area", RANK_BITS) + F.col("__province")).alias("pair"))
    years = _roster_years(t, []).select("id", "Reference_Year").distinct()
    j = years.join(m, "id").join(ind.select("id", "Industry"), "id")
    per_id = j.groupBy("Industry", "Reference_Year", "id").agg(F.min("pair").alias("pair"))
    out = per_id.groupBy("Industry", "Reference_Year").agg(
        F.count(F.lit(1)).alias("Number_Of_Establishments"), F.min("pair").alias("pair"))
    out = out.withColumn("__area", F.shiftright("pair", RANK_BITS)).withColumn("__province", F.col("pair").bitwiseAND(_RANK))
    out = _label_of(out, "__area", areas, "area_council_desc", "Area_Council")
    out = _label_of(out, "__province", provinces, "province_desc", "Province")
    out = out.select("Area_Council", "Province", "Reference_Year", "Industry", "Number_Of_Establishments")
    return out.orderBy("Industry") if sort else out


def size_sales_rows(t: Tables, ind: DataFrame, years: Iterable[str] = REPORT_YEARS,
                    filter_first: bool = False) -> DataFrame:
    """The rows Tables 2 and 5 show: one per establishment, kept if *that
    row's* year is one of ``years`` (A5).  The row is first by year label,
    IndustryType, Industry, paid employees, informal paid employees, sales.
    Table 2 leaves out sales, the last tie-break, so it is a projection of
    these rows, and both tables can share one pass over the roster.

    ``filter_first=True`` is the title's version (SURVEY 2.12): the year list
    is cut to ``years`` before the row is chosen, so every establishment with
    a row in one of the years appears."""
    r = _roster_years(t, ["tot_paid_emp", "sales_goods_services"],
                      only=list(years) if filter_first else None)
    r = representative_rows(r, "id", ["Reference_Year", "tot_paid_emp", "sales_goods_services"])
    j = r.join(_first_sector(t, ind), "id").join(t["main"].select("id", "infor_paidEmp"), "id")
    return (j.where(label_in("Reference_Year", list(years)))
            .select("id", "Industry", "Reference_Year", "IndustryType", "tot_paid_emp",
                    "infor_paidEmp", "sales_goods_services"))


def size_by_industry(t: Tables, ind: DataFrame, years: Iterable[str] = REPORT_YEARS,
                     sort: bool = True, rows: DataFrame | None = None) -> DataFrame:
    """R7 ``Table_2``: one row per establishment (``GROUP BY Industry.id,
    ref_yearDetails.id``, equal by the join), kept if *that row's* year is one
    of ``years`` (A5), sorted by ``Paid_Emp_Formal`` with missing first.
    ``rows`` may pass ``size_sales_rows`` computed once for Tables 2 and 5."""
    rows = rows if rows is not None else size_sales_rows(t, ind, years)
    if sort:
        # ``id`` only breaks ties: establishments of one size (or of none) can
        # then be sorted by several tasks
        rows = rows.orderBy(F.col("tot_paid_emp").asc_nulls_first(), "id")
    return rows.select("Industry", "Reference_Year", F.col("IndustryType").alias("Sector"),
                       F.col("tot_paid_emp").alias("Paid_Emp_Formal"),
                       F.col("infor_paidEmp").alias("Paid_Emp_Informal"))


def legal_status_rows(t: Tables, ind: DataFrame) -> DataFrame:
    """One row per (establishment, legal status), the one with the earliest
    year label (then IndustryType, Industry, Legal_Status): the rows Tables 3
    and 4 test, so both can share one pass over the roster.  Labels are
    compared by their ranks: every aggregate is a hash aggregate."""
    sectors, statuses = _sector_labels(t), _ranked(t["legal_status"], "legal_status_desc")
    years = _ranked(_years(t), "reference_year_desc")
    r = label_join(t["ref_yearDetails"].select("id", "ref_yearDetails__id"), years, "ref_yearDetails__id", "reference_year",
                   {"rank": "__year"})
    first_year = r.groupBy("id").agg(F.min("__year").alias("__year"))
    m = t["main"].select("id", F.col("legal_status").alias("legal_status_code"))
    m = label_join(m, statuses, "legal_status_code", "legal_status", {"rank": "__status"})
    j = first_year.join(_with_sector_rank(ind, sectors), "id").join(m, "id")
    place = F.shiftleft("sector", RANK_BITS - 1) + F.col("__status")
    rep = j.groupBy("id", "legal_status_code").agg(F.min("__year").alias("__year"), F.min(place).alias("place"))
    rep = rep.withColumn("sector", F.shiftright("place", RANK_BITS - 1)).withColumn(
        "__status", F.col("place").bitwiseAND(_RANK >> 1))
    rep = _label_of(_sector_of(rep, sectors), "__status", statuses, "legal_status_desc", "Legal_Status")
    rep = _label_of(rep, "__year", years, "reference_year_desc", "Reference_Year")
    return rep.select("Industry", "IndustryType", "Reference_Year", "Legal_Status")


def legal_status_in_year(t: Tables, ind: DataFrame, year: str,
                         rows: DataFrame | None = None) -> DataFrame:
    """R8/R9 ``Table_3``/``Table_4``: one row per (establishment, legal
    status), kept if that row's year is ``year`` (A5).  The row is the one
    with the earliest year label, so an establishment reporting several
    years lands in the table of its first year only, as in the reference."""
    rows = rows if rows is not None else legal_status_rows(t, ind)
    return rows.where(label_in("Reference_Year", [year]))


def sales_by_industry(t: Tables, ind: DataFrame, years: Iterable[str] = REPORT_YEARS,
                      rows: DataFrame | None = None) -> DataFrame:
    """R10 ``Table_5``: as Table_2 plus ``Total_Sales``, unsorted."""
    rows = rows if rows is not None else size_sales_rows(t, ind, years)
    return rows.select("Reference_Year", "Industry", "IndustryType",
                       F.col("tot_paid_emp").alias("Paid_Emp_Formal"),
                       F.col("infor_paidEmp").alias("Paid_Emp_Informal"),
                       F.col("sales_goods_services").alias("Total_Sales"))


# Table_6/7 measure columns and their published names, in order.
EMPLOYEE_MEASURES = {
    "local_emp": "Local_Emp",
    "foreign_emp": "Foreign_Empl",
    "mang_vanmale": "NiVan_Male_Managerial_Skills",
    "skill_vanmale": "Skilled_NiVan_Male",
    "unskil_vanmale": "Unskilled_NiVan_Male",
    "mang_vanfemale": "NiVan_Female_Managerial_Skills",
    "skill_vanfemale": "Skilled_NiVan_Female",
}
# Table_8/9 measure columns, in order.
COMPENSATION_MEASURES = ("local_emp", "foreign_emp", "employee_comp")
# Table_10 measure columns, in order.
SKILL_MEASURES = (
    "mang_vanmale", "skill_vanmale", "unskil_vanmale",
    "mang_vanfemale", "skill_vanfemale", "unskil_vanfemale",
    "mang_formale", "skill_formale", "unskil_formale",
    "mang_forfemale", "skill_forfemale", "unskil_forfemale",
)


def _per_year_rows(t: Tables, ind: DataFrame, measures: list[str], only=None,
                   require_main: bool = False) -> DataFrame:
    """Shared body of Tables 6-10: one row per (establishment, year code),
    Industry/IndustryType first in the tie-break, then the measures."""
    r = _roster_years(t, measures, only)
    r = representative_rows(r, ["id", "ref_yearDetails__id"], measures)
    if require_main:
        r = exists_join(r, t["main"], "id")
    return r.join(_first_sector(t, ind), "id")


def employee_rows(t: Tables, ind: DataFrame, years: Iterable[str] = REPORT_YEARS) -> DataFrame:
    """Rows of Tables 6 and 7 for all their ``years`` at once (one roster pass
    for both); each table keeps its year."""
    return _per_year_rows(t, ind, list(EMPLOYEE_MEASURES), only=list(years))


def employees_in_year(t: Tables, ind: DataFrame, year: str,
                      rows: DataFrame | None = None) -> DataFrame:
    """R11/R12 ``Table_6``/``Table_7``: per (establishment, year code) of
    ``year``.  The tested label is fixed by the group's year code (A6), so the
    year list is filtered before the join and the roster is pruned early.
    ``rows`` may pass ``employee_rows`` computed once for both years."""
    j = (rows.where(label_in("Reference_Year", [year])) if rows is not None
         else _per_year_rows(t, ind, list(EMPLOYEE_MEASURES), only=[year]))
    return j.select("Industry", "IndustryType",
                    *[F.col(c).alias(a) for c, a in EMPLOYEE_MEASURES.items()])


def compensation_rows(t: Tables, ind: DataFrame, years: Iterable[str] = REPORT_YEARS) -> DataFrame:
    """Rows of Tables 8 and 9 for all their ``years`` at once."""
    return _per_year_rows(t, ind, list(COMPENSATION_MEASURES), only=list(years),
                          require_main=True)


def compensation_in_year(t: Tables, ind: DataFrame, year: str,
                         rows: DataFrame | None = None) -> DataFrame:
    """R13/R14 ``Table_8``/``Table_9``: as R11 with compensation measures;
    ``main`` only has to exist (J5, semi join)."""
    j = (rows.where(label_in("Reference_Year", [year])) if rows is not None
         else _per_year_rows(t, ind, list(COMPENSATION_MEASURES), only=[year], require_main=True))
    return j.select("Reference_Year", "Industry", "IndustryType", *COMPENSATION_MEASURES)


def skills_all_years(t: Tables, ind: DataFrame) -> DataFrame:
    """R15 ``Table_10``: skill measures per (establishment, year code), all
    years (the reference has no year filter)."""
    j = _per_year_rows(t, ind, list(SKILL_MEASURES), require_main=True)
    return j.select("Reference_Year", "Industry", "IndustryType", *SKILL_MEASURES)


def industry_years(t: Tables, ind: DataFrame) -> DataFrame:
    """Roster rows per (Industry, Reference_Year) and establishment (count
    ``n``): counted per (id, year) before the join, so an establishment with
    very many rows is one row in it."""
    r = _roster_years(t, []).groupBy("id", "Reference_Year").agg(F.count(F.lit(1)).alias("n"))
    return r.join(ind.select("id", "Industry"), "id")


def pilot_extract(t: Tables) -> DataFrame:
    """R16 ``pilotData``: establishments with their labels, one row per
    registration (fan-out kept, J7)."""
    m = t["main"].select("id", "name_businesEsta", "busines_start_for", "business_locate",
                         "area_council", "legal_status", "account_keeping")
    m = label_join(m, t["area_council"], "area_council", "area_council",
                   {"area_council_desc": "LOCATION"})
    m = label_join(m, t["legal_status"], "legal_status", "legal_status",
                   {"legal_status_desc": "LEGALSTAT"})
    m = label_join(m, t["account_keeping"], "account_keeping", "account_keeping",
                   {"account_keeping_desc": "ACCOUNTS"})
    reg = label_join(t["register_id"].select("id", "register_id__id"), t["institution_reg"],
                     "register_id__id", "institution_reg",
                     {"institution_reg_desc": "Registration"})
    j = m.join(reg, "id")
    return j.select("id", F.col("name_businesEsta").alias("NAME"),
                    F.col("busines_start_for").alias("YEAR"),
                    F.col("business_locate").alias("ESTAB_NO"),
                    "LOCATION", "Registration", "LEGALSTAT", "ACCOUNTS")


# ---------------------------------------------------------------------------
# Optional, separately named variants implied by the report titles.  They
# never replace the as-written tables above.
# ---------------------------------------------------------------------------

def legal_status_by_year(t: Tables, ind: DataFrame, year: str) -> DataFrame:
    """Title version of R8/R9: every establishment with a row in ``year``
    (year filtered *before* choosing the row), counted per Industry,
    IndustryType and Legal_Status."""
    ids = _roster_years(t, [], only=[year]).select("id").distinct()
    m = label_join(t["main"].select("id", "legal_status"), t["legal_status"], "legal_status",
                   "legal_status", {"legal_status_desc": "Legal_Status"})
    j = ids.join(ind.select("id", "Industry", "IndustryType"), "id").join(m, "id")
    return (j.groupBy("Industry", "IndustryType", "Legal_Status")
            .agg(F.countDistinct("id").alias("Number_Of_Establishments"))
            .withColumn("Reference_Year", F.lit(year)))


def measure_totals_by_year(t: Tables, ind: DataFrame, measures: Iterable[str],
                           years: Iterable[str] = REPORT_YEARS) -> DataFrame:
    """Title version of Tables 2 and 5-10: per (Industry, IndustryType,
    Reference_Year) the number of establishments and the sum of each
    measure over every roster row of the year (year filtered first, no row
    choice).  An establishment with both sector codes counts in both.

    Aggregation runs in levels instead of ``countDistinct`` next to sums
    (which Spark plans by expanding every row).  The roster is first summed
    per (id, year), which shrinks it before the join.  Then per (keys, id),
    which needs no exchange after the join on id and keeps the count of
    establishments exact.  Then per keys, counting ids and adding the
    partial sums map-side.  A hot industry is spread by id until the last,
    small exchange.
    """
    measures = list(measures)
    keys = ["Industry", "IndustryType", "Reference_Year"]
    r = _roster_years(t, measures, only=list(years))
    per_year = r.groupBy("id", "Reference_Year").agg(*[F.sum(c).alias(c) for c in measures])
    j = per_year.join(ind.select("id", "Industry", "IndustryType"), "id")
    per_id = j.groupBy(*keys, "id").agg(*[F.sum(c).alias(c) for c in measures])
    return (per_id.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("Number_Of_Establishments"),
                 *[F.sum(c).alias(f"Total_{c}") for c in measures]))
