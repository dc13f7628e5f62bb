"""DuckDB oracle SQL for every catalogue query that SQL can express.

Conventions that keep the comparison exact:
  * every ``ROW_NUMBER`` orders ``NULLS FIRST`` like Spark's ascending sort;
  * ``trunc`` before an integer cast (DuckDB rounds, R and Spark truncate);
  * ``SUM`` of integers is cast back to BIGINT (DuckDB widens to HUGEINT);
  * label joins compare ``TRY_CAST(text AS DOUBLE)`` with the numeric code.
"""

from __future__ import annotations

from fieldstat.plans.catalogue import (ARCHIVE_ROWS, BIG, BROKEN_NAME_SQL, DIRTY_SQL, HARD_NAME_SQL, YEAR,
                                       YEARS)
from fieldstat.plans.reports import SKILL_MEASURES
from fieldstat.plans.standins import with_standins


def _n(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


def _nf(*cols: str) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def _q(x: str) -> str:
    """R write.csv text field."""
    return f"""COALESCE('"' || replace({x}, '"', '""') || '"', 'NA')"""


_YEARS_IN = ", ".join(f"'{y}'" for y in YEARS)

SQL: dict[str, str] = {}

SQL["label_join"] = f"""WITH {DIRTY_SQL}
SELECT c.c_custkey, c.c_name, b.n_name AS nation_label
FROM customer c JOIN big b
  ON CASE WHEN c.c_mktsegment = 'BUILDING' THEN c.c_nationkey + {BIG} ELSE c.c_nationkey END = b.n_nationkey"""

SQL["mixed_type_label_join"] = f"""WITH {DIRTY_SQL}
SELECT d.c_custkey, d.area_code, b.n_name AS area_label
FROM coded d JOIN big b ON d.code = b.n_nationkey"""

SQL["unmatched_codes"] = f"""WITH {DIRTY_SQL}
SELECT d.c_custkey, d.area_code FROM coded d
WHERE d.code IS NULL OR NOT EXISTS (SELECT 1 FROM big b WHERE d.code = b.n_nationkey)"""

SQL["star_labels"] = """
SELECT o.o_orderkey, o.o_custkey AS id, c.c_name, n.n_name AS area_council_desc,
       r.r_name AS province_desc
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

SQL["roster_fanout"] = """
SELECT o.o_custkey AS id, o.o_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""

SQL["exists_join"] = """
SELECT o.o_orderkey, o.o_custkey AS id, o.o_totalprice FROM orders o
WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey
              AND c.c_mktsegment = 'HOUSEHOLD')"""

SQL["merge_null_keys"] = """
WITH x AS (SELECT c_custkey, NULLIF(c_nationkey, 0) AS nation_code FROM customer),
     y AS (SELECT NULLIF(n_nationkey, 0) AS nation_code, n_name FROM nation)
SELECT COALESCE(x.nation_code, y.nation_code) AS nation_code, x.c_custkey, y.n_name
FROM x JOIN y ON x.nation_code IS NOT DISTINCT FROM y.nation_code"""

SQL["merge_suffixes"] = with_standins("acts", "errs") + """,
a AS (SELECT id, COUNT(*) AS n, max(time) AS last_action FROM acts GROUP BY id),
e AS (SELECT id, COUNT(*) AS n FROM errs GROUP BY id)
SELECT a.id, a.n AS "n.x", a.last_action, e.n AS "n.y"
FROM a JOIN e ON a.id IS NOT DISTINCT FROM e.id"""

SQL["positive_code_count"] = with_standins("main") + f""",
p AS (SELECT province, COUNT(id) AS total FROM main WHERE {_n('province')} > 0 GROUP BY province),
l AS (SELECT CAST(r_regionkey AS VARCHAR) AS province, r_name AS province_desc FROM region)
SELECT COALESCE(p.province, l.province) AS province, p.total, l.province_desc
FROM p JOIN l ON p.province IS NOT DISTINCT FROM l.province"""

SQL["errors_by_variable"] = with_standins("errs") + """
SELECT variable, COUNT(id) AS total FROM errs GROUP BY variable"""

SQL["errors_by_interview"] = with_standins("errs") + """
SELECT id, COUNT(id) AS totError FROM errs GROUP BY id"""

_FIRST_ACTION = f"""first_action AS (
  SELECT id, originator, responsible__name, date, time, line_no FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY id, originator
                                 ORDER BY {_nf('line_no', 'date', 'time', 'responsible__name')}) AS rn
    FROM acts) WHERE rn = 1)"""

SQL["first_action"] = with_standins("acts") + "," + _FIRST_ACTION + """
SELECT * FROM first_action"""

SQL["errors_by_originator"] = with_standins("acts", "errs") + "," + _FIRST_ACTION + """,
chk AS (SELECT id, COUNT(id) AS totError FROM errs GROUP BY id)
SELECT f.originator, CAST(SUM(c.totError) AS BIGINT) AS totError
FROM chk c JOIN first_action f ON c.id IS NOT DISTINCT FROM f.id GROUP BY f.originator"""

SQL["interviewer_errors"] = with_standins("acts", "errs") + "," + _FIRST_ACTION + """,
chk AS (SELECT id, COUNT(id) AS totError FROM errs GROUP BY id)
SELECT COALESCE(c.id, f.id) AS id, c.totError, f.originator, f.responsible__name, f.date,
       f.time, f.line_no
FROM chk c JOIN first_action f ON c.id IS NOT DISTINCT FROM f.id"""

SQL["sector_union"] = with_standins("main", "industry") + """
SELECT id, name_businesEsta, Industry, IndustryType FROM industry"""

_FWM = f"""fwm AS (
  SELECT id, interview_status_desc, originator, responsible__name, enumdesc, date, start_time, start_end_time,
         Ref_Letter, ref_number, Business_Name,
         concat_ws(' ', COALESCE(Ref_Letter, 'NA'), COALESCE(ref_number, 'NA')) AS Reference_Number
  FROM (SELECT m.id, st.r_name AS interview_status_desc, a.originator, a.responsible__name,
               e.enumdesc, a.date, rl.n_name AS Ref_Letter, m.ref_number,
               m.name_businesEsta AS Business_Name, m.start_time, m.start_end_time,
               ROW_NUMBER() OVER (PARTITION BY m.id ORDER BY
                   {_nf('a.date', 'a.originator', 'a.responsible__name', 'e.enumdesc', 'a.time', 'a.line_no')}) AS rn
        FROM acts a
        JOIN main m ON a.id = m.id
        JOIN region st ON {_n('m.interview__status')} = CAST(st.r_regionkey AS DOUBLE)
        JOIN enumerators e ON a.originator = e.enum
        JOIN nation rl ON {_n('m.ref_letter')} = CAST(rl.n_nationkey AS DOUBLE)) r
  WHERE rn = 1)"""

SQL["fieldwork_monitor"] = with_standins("main", "acts", "enumerators") + "," + _FWM + """
SELECT * FROM fwm"""

SQL["fieldwork_durations"] = with_standins("main", "acts", "enumerators") + "," + _FWM + """
SELECT id, replace(start_time, 'T', ' ') AS start_text, split_part(start_end_time, 'T', 2) AS end_clock,
       CAST(start_time AS TIMESTAMP) AS started,
       date_diff('second', CAST(start_time AS TIMESTAMP), CAST(start_end_time AS TIMESTAMP)) / 60.0 AS minutes
FROM fwm"""

# Fixed value: the published file's header line.
_CSV_HEADER = ('"id","Reference_Number","Business_Name","Major_Label_Vansic","IndustryType","originator",'
               '"responsible__name","enumdesc","date"')
_CSV_FIELDS = " || ',' || ".join([
    "CAST(f.id AS VARCHAR)", _q("f.Reference_Number"), _q("f.Business_Name"),
    _q("i.Industry"), _q("i.IndustryType"), _q("f.originator"), _q("f.responsible__name"),
    _q("f.enumdesc"), "COALESCE(strftime(f.date, '%Y-%m-%d'), 'NA')",
])

SQL["fieldwork_export_lines"] = with_standins("main", "acts", "enumerators", "industry") + "," + _FWM + f"""
SELECT '{_CSV_HEADER}' AS value
UNION ALL
SELECT {_CSV_FIELDS} AS value FROM fwm f JOIN industry i ON f.id = i.id"""

SQL["fieldwork_industry"] = with_standins("main", "acts", "enumerators", "industry") + "," + _FWM + """
SELECT f.id, f.Reference_Number, f.Business_Name, i.Industry AS Major_Label_Vansic, i.IndustryType,
       f.originator, f.responsible__name, f.enumdesc, f.date
FROM fwm f JOIN industry i ON f.id = i.id"""

_T1 = f"""
j AS (SELECT a.n_name AS Area_Council, p.r_name AS Province,
             y.reference_year_desc AS Reference_Year, i.Industry, i.id
      FROM main m
      JOIN nation a ON {_n('m.area_council')} = CAST(a.n_nationkey AS DOUBLE)
      JOIN region p ON {_n('m.province')} = CAST(p.r_regionkey AS DOUBLE)
      JOIN ry ON m.id = ry.id
      JOIN reference_year y ON {_n('ry.ref_yearDetails__id')} = CAST(y.reference_year AS DOUBLE)
      JOIN industry i ON m.id = i.id),
c AS (SELECT Industry, Reference_Year, COUNT(DISTINCT id) AS Number_Of_Establishments
      FROM j GROUP BY Industry, Reference_Year),
r AS (SELECT Industry, Reference_Year, Area_Council, Province,
             ROW_NUMBER() OVER (PARTITION BY Industry, Reference_Year
                                ORDER BY {_nf('Area_Council', 'Province')}) AS rn FROM j)
SELECT r.Area_Council, r.Province, c.Reference_Year, c.Industry, c.Number_Of_Establishments
FROM c JOIN r ON c.Industry = r.Industry AND c.Reference_Year = r.Reference_Year AND r.rn = 1"""

SQL["establishments_by_industry_year"] = with_standins(
    "main", "ry", "reference_year", "industry") + "," + _T1


def _size(extra_cols: str, extra_order: tuple[str, ...], select: str,
          filter_first: bool = False) -> str:
    first = f"WHERE y.reference_year_desc IN ({_YEARS_IN})" if filter_first else ""
    return with_standins("main", "ry", "reference_year", "industry") + f""",
j AS (SELECT i.Industry, y.reference_year_desc AS Reference_Year, i.IndustryType,
             ry.tot_paid_emp, m.infor_paidEmp{extra_cols}, ry.id AS gid
      FROM ry JOIN industry i ON ry.id = i.id
      JOIN main m ON ry.id = m.id
      JOIN reference_year y ON {_n('ry.ref_yearDetails__id')} = CAST(y.reference_year AS DOUBLE)
      {first}),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY gid ORDER BY
        {_nf('Reference_Year', 'IndustryType', 'Industry', 'tot_paid_emp', 'infor_paidEmp', *extra_order)}) AS rn
      FROM j)
SELECT {select} FROM r WHERE rn = 1 AND Reference_Year IN ({_YEARS_IN})"""


SQL["size_by_industry"] = _size("", (), "Industry, Reference_Year, IndustryType AS Sector, "
                                        "tot_paid_emp AS Paid_Emp_Formal, "
                                        "infor_paidEmp AS Paid_Emp_Informal")

SQL["sales_by_industry"] = _size(", ry.sales_goods_services", ("sales_goods_services",),
                                 "Reference_Year, Industry, IndustryType, "
                                 "tot_paid_emp AS Paid_Emp_Formal, "
                                 "infor_paidEmp AS Paid_Emp_Informal, "
                                 "sales_goods_services AS Total_Sales")

SQL["size_by_industry_by_year"] = _size("", (), "Industry, Reference_Year, IndustryType AS Sector, "
                                                "tot_paid_emp AS Paid_Emp_Formal, "
                                                "infor_paidEmp AS Paid_Emp_Informal", filter_first=True)

SQL["sales_by_industry_by_year"] = _size(", ry.sales_goods_services", ("sales_goods_services",),
                                         "Reference_Year, Industry, IndustryType, "
                                         "tot_paid_emp AS Paid_Emp_Formal, "
                                         "infor_paidEmp AS Paid_Emp_Informal, "
                                         "sales_goods_services AS Total_Sales", filter_first=True)

SQL["legal_status_in_year"] = with_standins("main", "ry", "reference_year", "industry") + f""",
j AS (SELECT i.Industry, i.IndustryType, y.reference_year_desc AS Reference_Year,
             ls.r_name AS Legal_Status, i.id AS gid, ls.r_regionkey AS gls
      FROM ry JOIN industry i ON ry.id = i.id
      JOIN reference_year y ON {_n('ry.ref_yearDetails__id')} = CAST(y.reference_year AS DOUBLE)
      JOIN main m ON ry.id = m.id
      JOIN region ls ON {_n('m.legal_status')} = CAST(ls.r_regionkey AS DOUBLE)),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY gid, gls ORDER BY
        {_nf('Reference_Year', 'IndustryType', 'Industry', 'Legal_Status')}) AS rn FROM j)
SELECT Industry, IndustryType, Reference_Year, Legal_Status FROM r
WHERE rn = 1 AND Reference_Year = '{YEAR}'"""

SQL["legal_status_by_year"] = with_standins("main", "ry", "reference_year", "industry") + f""",
ids AS (SELECT DISTINCT ry.id FROM ry
        JOIN reference_year y ON {_n('ry.ref_yearDetails__id')} = CAST(y.reference_year AS DOUBLE)
        WHERE y.reference_year_desc = '{YEAR}')
SELECT i.Industry, i.IndustryType, ls.r_name AS Legal_Status,
       COUNT(DISTINCT ids.id) AS Number_Of_Establishments, '{YEAR}' AS Reference_Year
FROM ids JOIN industry i ON ids.id = i.id JOIN main m ON ids.id = m.id
JOIN region ls ON {_n('m.legal_status')} = CAST(ls.r_regionkey AS DOUBLE)
GROUP BY i.Industry, i.IndustryType, ls.r_name"""

# Table_6/7 measure columns and their published names, in order.
_EMP = [("local_emp", "Local_Emp"), ("foreign_emp", "Foreign_Empl"),
        ("mang_vanmale", "NiVan_Male_Managerial_Skills"), ("skill_vanmale", "Skilled_NiVan_Male"),
        ("unskil_vanmale", "Unskilled_NiVan_Male"),
        ("mang_vanfemale", "NiVan_Female_Managerial_Skills"),
        ("skill_vanfemale", "Skilled_NiVan_Female")]


def _per_year(measures: list[str], out_cols: str, with_main: bool, year: str | None,
              year_first: bool) -> str:
    mcols = ", ".join(f"ry.{c}" for c in measures)
    main_join = "JOIN main m ON ry.id = m.id" if with_main else ""
    order = ("IndustryType", "Reference_Year", "Industry") if year_first else ("IndustryType", "Industry")
    where = f"AND Reference_Year = '{year}'" if year else ""
    return with_standins("main", "ry_measures", "reference_year", "industry") + f""",
j AS (SELECT i.Industry, i.IndustryType, y.reference_year_desc AS Reference_Year, {mcols},
             i.id AS gid, ry.ref_yearDetails__id AS gyr
      FROM ry
      JOIN reference_year y ON {_n('ry.ref_yearDetails__id')} = CAST(y.reference_year AS DOUBLE)
      JOIN industry i ON ry.id = i.id
      {main_join}),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY gid, gyr ORDER BY
        {_nf(*order, *measures)}) AS rn FROM j)
SELECT {out_cols} FROM r WHERE rn = 1 {where}"""


SQL["employees_in_year"] = _per_year(
    [c for c, _ in _EMP],
    "Industry, IndustryType, " + ", ".join(f"{c} AS {a}" for c, a in _EMP),
    with_main=False, year=YEAR, year_first=False)

SQL["compensation_in_year"] = _per_year(
    ["local_emp", "foreign_emp", "employee_comp"],
    "Reference_Year, Industry, IndustryType, local_emp, foreign_emp, employee_comp",
    with_main=True, year=YEAR, year_first=True)

SQL["skills_all_years"] = _per_year(
    list(SKILL_MEASURES),
    "Reference_Year, Industry, IndustryType, " + ", ".join(SKILL_MEASURES),
    with_main=True, year=None, year_first=True)

SQL["pilot_extract"] = with_standins("main", "register_id") + f"""
SELECT m.id, m.name_businesEsta AS NAME, m.busines_start_for AS YEAR,
       m.business_locate AS ESTAB_NO, a.n_name AS LOCATION, ir.r_name AS Registration,
       ls.r_name AS LEGALSTAT, ak.r_name AS ACCOUNTS
FROM main m
JOIN nation a ON {_n('m.area_council')} = CAST(a.n_nationkey AS DOUBLE)
JOIN register_id g ON m.id = g.id
JOIN region ir ON {_n('g.register_id__id')} = CAST(ir.r_regionkey AS DOUBLE)
JOIN region ls ON {_n('m.legal_status')} = CAST(ls.r_regionkey AS DOUBLE)
JOIN region ak ON {_n('m.account_keeping')} = CAST(ak.r_regionkey AS DOUBLE)"""

_IY = f""",
iy AS (SELECT i.Industry, y.reference_year_desc AS Reference_Year
       FROM ry JOIN reference_year y ON {_n('ry.ref_yearDetails__id')} = CAST(y.reference_year AS DOUBLE)
       JOIN industry i ON ry.id = i.id)"""

SQL["industry_year_crosstab"] = with_standins("main", "ry", "reference_year", "industry") + _IY + """
SELECT Industry, """ + ", ".join(
    f"""NULLIF(COUNT(*) FILTER (WHERE Reference_Year = '{y}'), 0) AS "{y}\""""
    for y in range(1995, 2002)) + """
FROM iy GROUP BY Industry"""

SQL["table_1_pivot"] = with_standins("main", "ry", "reference_year", "industry") + _IY + """
SELECT Industry, """ + ", ".join(
    f"""NULLIF(COUNT(*) FILTER (WHERE Reference_Year = '{y}'), 0) AS "{y}\""""
    for y in range(1995, 2002)) + f"""
FROM (SELECT DISTINCT i.Industry, y.reference_year_desc AS Reference_Year
      FROM ry JOIN reference_year y ON ry.ref_yearDetails__id = CAST(y.reference_year AS VARCHAR)
      JOIN industry i ON ry.id = i.id JOIN main m ON ry.id = m.id
      JOIN nation a ON m.area_council = CAST(a.n_nationkey AS VARCHAR)
      JOIN region p ON m.province = CAST(p.r_regionkey AS VARCHAR)) GROUP BY Industry"""

SQL["industry_year_totals"] = with_standins("main", "ry", "reference_year", "industry") + _IY + """
SELECT Industry, Reference_Year, COUNT(*) AS n, GROUPING(Industry, Reference_Year) AS total_level
FROM iy GROUP BY CUBE (Industry, Reference_Year)"""


def _int(x: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER)"


SQL["cast_integer"] = f"""
SELECT p_partkey,
       {_int('CAST(p_retailprice / 7 AS VARCHAR)')} AS from_text,
       {_int('-p_retailprice / 7')} AS from_negative,
       {_int('p_retailprice * 1e7')} AS from_too_large,
       {_int('p_brand')} AS from_label,
       p_size AS from_padded,
       CASE WHEN p_size % 3 = 2 THEN p_size * 10 END AS from_suffixed,
       {_int('CAST(p_size AS VARCHAR)')} AS from_int_text
FROM part"""

SQL["to_integer_columns"] = f"""
SELECT c_custkey, {_int('CAST(c_acctbal AS VARCHAR)')} AS acctbal_text,
       {_int('c_acctbal * 1000')} AS acctbal_milli
FROM customer"""

# R prints the shortest decimal text of a double (no exponent for these
# magnitudes); DuckDB's VARCHAR cast of a double is that text too.
_CAT = """CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR)
     ELSE CAST({x} AS VARCHAR) END"""

SQL["category_text"] = f"""
SELECT c_custkey, {_CAT.format(x='c_acctbal')} AS acctbal_label,
       {_CAT.format(x='CAST(c_nationkey AS DOUBLE)')} AS nation_label,
       c_mktsegment AS segment_label,
       printf('%.15g', c_acctbal / 7) AS digits_label,
       rtrim(rtrim('0.' || lpad(CAST(c_custkey AS VARCHAR), 20, '0'), '0'), '.') AS tiny_label,
       '00' || CAST(c_nationkey AS VARCHAR) AS text_label
FROM customer"""

SQL["epoch_day_to_date"] = """
WITH d AS (SELECT o_orderkey,
                  CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) + 0.75
                  AS day_number FROM orders)
SELECT o_orderkey, day_number, DATE '1970-01-01' + CAST(floor(day_number) AS INTEGER) AS order_day,
       CAST(2932896 + o_orderkey AS INTEGER) AS late_day
FROM d"""

SQL["paste_missing"] = """
SELECT c_custkey, concat_ws(' ', COALESCE(NULLIF(c_mktsegment, 'HOUSEHOLD'), 'NA'),
                            COALESCE(CAST(c_nationkey AS VARCHAR), 'NA')) AS Reference_Number,
       concat_ws(' ', 'LS', CAST(c_nationkey AS VARCHAR), printf('%.15g', c_nationkey / 4)) AS number_parts
FROM customer"""

SQL["clean_time_text"] = """
WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso_text FROM events)
SELECT event_id, iso_text, replace(iso_text, 'T', ' ') AS spaced_text,
       regexp_replace(iso_text, '^[^T]*T', '') AS clock_text,
       strptime(iso_text, '%Y-%m-%dT%H:%M:%S') AS parsed, strptime(iso_text, '%Y-%m-%dT%H:%M:%S') AS parsed_mdy,
       strptime(iso_text, '%Y-%m-%dT%H:%M:%S') AS parsed_dashes, strptime(iso_text, '%Y-%m-%dT%H:%M:%S') AS parsed_dots
FROM e"""

SQL["minutes_between"] = """
SELECT event_id,
       (epoch_us(ts) - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))) / 60000000.0 AS minutes
FROM events"""

SQL["fill_missing"] = """
SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'HOUSEHOLD'), '') AS segment,
       COALESCE(NULLIF(c_nationkey, 0), 0) AS nation
FROM customer"""

SQL["rename_first_drop_range"] = """
SELECT l_orderkey AS id, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate
FROM lineitem"""

SQL["status_extract"] = """
SELECT * FROM orders WHERE o_orderstatus = 'F'"""

SQL["zip_members"] = f"""
SELECT c_custkey, {BROKEN_NAME_SQL} AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"""

SQL["first_action_in_archives"] = f"""
WITH log AS (
  SELECT user_id AS id, event_type AS originator,
         event_type || CASE WHEN event_id % 7 = 0 THEN chr(10) || 'second line' ELSE '' END AS responsible__name,
         CAST(ts AS DATE) AS date, event_id, -(event_id // {ARCHIVE_ROWS}) AS archive, event_id % 7 = 0 AS broken FROM events),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY archive) + row_number() OVER w - 1
            + COALESCE(SUM(broken::INT) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_no
  FROM log WINDOW w AS (ORDER BY archive, event_id))
SELECT id, originator, responsible__name, date, CAST(line_no AS BIGINT) AS line_no FROM numbered
QUALIFY row_number() OVER (PARTITION BY id, originator ORDER BY line_no) = 1"""

SQL["code_list_catalog"] = """
SELECT 'area_council' AS list_name, CAST(n_nationkey AS DOUBLE) AS code, n_name AS label FROM nation
UNION ALL
SELECT 'province' AS list_name, CAST(r_regionkey AS DOUBLE) AS code,
       CASE WHEN r_regionkey = 0 THEN 'NA' ELSE r_name END AS label FROM region"""

SQL["guessed_types"] = """
SELECT CAST(o_orderkey AS DOUBLE) AS key, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price,
       CAST(o_orderdate AS DATE) AS day,
       CASE WHEN o_orderkey % 3 = 0 THEN date_trunc('second', o_orderdate) ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS moment,
       o_totalprice > 100000 AS large, lpad(CAST(o_orderkey % 1000 AS VARCHAR), 4, '0') AS code,
       CASE WHEN o_orderkey = 1 THEN '1d' ELSE CAST(o_orderkey % 7 AS VARCHAR) END AS odd,
       CAST(NULL AS VARCHAR) AS nothing, o_orderpriority FROM orders"""

SQL["comma_csv_list"] = """
SELECT CAST(r_regionkey AS DOUBLE) AS province,
       CASE WHEN r_regionkey <> 2 THEN '"' || r_name || '", north' END AS province_desc FROM region"""

SQL["layer_round_trip"] = f"""
SELECT o_orderkey AS id, o_custkey, o_orderstatus, {_int('o_totalprice')} AS o_totalprice, o_orderdate, o_orderpriority
FROM orders"""


def _totals(standin: str, measures: list[str]) -> str:
    sums = ", ".join(f"CAST(SUM(ry.{c}) AS BIGINT) AS Total_{c}" for c in measures)
    return with_standins("main", standin, "reference_year", "industry") + f"""
SELECT i.Industry, i.IndustryType, y.reference_year_desc AS Reference_Year,
       COUNT(DISTINCT ry.id) AS Number_Of_Establishments, {sums}
FROM ry
JOIN reference_year y ON {_n('ry.ref_yearDetails__id')} = CAST(y.reference_year AS DOUBLE)
JOIN industry i ON ry.id = i.id
WHERE y.reference_year_desc IN ({_YEARS_IN})
GROUP BY i.Industry, i.IndustryType, y.reference_year_desc"""


SQL["size_totals_by_year"] = _totals("ry", ["tot_paid_emp"])
SQL["sales_totals_by_year"] = _totals("ry", ["sales_goods_services"])
SQL["employee_totals_by_year"] = _totals("ry_measures", [c for c, _ in _EMP])
SQL["skill_totals_by_year"] = _totals(
    "ry_measures", ["local_emp", "foreign_emp", "employee_comp", *SKILL_MEASURES])

SQL["delimited_round_trip"] = f"""
SELECT c_custkey, {HARD_NAME_SQL} AS c_name, NULLIF(c_nationkey, 0) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer"""

SQL["orders_csv_lines"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) || ',' || {_q('o_orderstatus')} || ',' ||
       COALESCE({_CAT.format(x='o_totalprice')}, 'NA') || ',' ||
       COALESCE(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 'NA') || ',' ||
       {_q('o_orderpriority')} AS value
FROM orders"""

SQL["merge_heavy_keys"] = """
WITH x AS (
  SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 3 = 1 THEN o_custkey % 1000 + 100 END AS code
  FROM orders), y AS (
  SELECT c_custkey, c_name, CASE WHEN c_custkey % 200 = 0 THEN 7 WHEN c_custkey % 200 = 50 THEN c_custkey % 1000 + 100 END AS code
  FROM customer WHERE c_custkey % 50 = 0)
SELECT x.code, o_orderkey, o_totalprice, c_custkey, c_name FROM x JOIN y ON x.code IS NOT DISTINCT FROM y.code"""

SQL["code_combinations"] = "WITH " + DIRTY_SQL + """,
flags AS (
  SELECT coded.code IS NULL OR coded.code NOT IN (SELECT n_nationkey FROM big) AS a,
         c.c_nationkey NOT IN (SELECT r_regionkey FROM region) AS r,
         lower(c.c_mktsegment) = 'machinery'
           OR c.c_mktsegment NOT IN (SELECT c_mktsegment FROM customer WHERE c_nationkey < 3) AS s
  FROM coded JOIN customer c USING (c_custkey)),
combos AS (
  SELECT concat_ws(',', CASE WHEN a THEN 'area' END, CASE WHEN r THEN 'region' END, CASE WHEN s THEN 'segment' END) AS unmatched,
         COUNT(*) AS n FROM flags GROUP BY a, r, s)
SELECT 'combination' AS level, unmatched, n FROM combos
UNION ALL SELECT 'list', 'area', COUNT(*) FROM flags WHERE a HAVING COUNT(*) > 0
UNION ALL SELECT 'list', 'region', COUNT(*) FROM flags WHERE r HAVING COUNT(*) > 0
UNION ALL SELECT 'list', 'segment', COUNT(*) FROM flags WHERE s HAVING COUNT(*) > 0"""

SQL["distinct_totals"] = with_standins("main", "ry", "reference_year", "industry") + """
SELECT i.Industry, y.reference_year_desc AS Reference_Year, COUNT(DISTINCT i.id) AS establishments,
       CAST(GROUPING(i.Industry) * 2 + GROUPING(y.reference_year_desc) AS BIGINT) AS total_level
FROM ry JOIN reference_year y ON TRY_CAST(ry.ref_yearDetails__id AS DOUBLE) = y.reference_year JOIN industry i ON i.id = ry.id
GROUP BY CUBE (i.Industry, y.reference_year_desc)"""

SQL["chosen_time_forms"] = """
SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN date_trunc('second', ts) END AS iso,
       CASE WHEN event_id % 11 <> 0 THEN date_trunc('second', ts) END AS clock,
       date_trunc('second', ts) AS short, date_trunc('second', ts) AS name FROM events"""

# the header line is 44 bytes
SQL["csv_parts"] = f"""
SELECT TRUE AS whole, CAST(SUM(length(value) + 1) + 44 AS BIGINT) AS bytes, COUNT(*) + 1 AS lines
FROM (SELECT CAST(o_orderkey AS VARCHAR) || ',' || {_q('o_orderstatus')} || ',' ||
             COALESCE({_CAT.format(x='o_totalprice')}, 'NA') AS value FROM orders)"""
