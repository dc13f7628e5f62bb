"""End-to-end batch run on an invented export (no real rows are used: the
published file holds names of people and businesses)."""

import glob
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from fieldstat.plans import pipeline as PL
from fieldstat.sinks.layers import read_layer
from fieldstat.sources.codelists import CODE_LISTS

RANGE_COLS = ([f"busiName_other__{i}" for i in range(15)] + [f"bus_activities__{i}" for i in range(1, 22)]
              + [f"hhld_exp__{i}" for i in range(1, 8)] + [f"finance_source__{i}" for i in range(1, 8)]
              + [f"mobile_money_service__{i}" for i in range(1, 5)])

MAIN_COLS = (["interview__key", "interview__status", "name_businesEsta", "start_time", "start_end_time",
              "busines_start_for"]
             + list(dict.fromkeys(PL.MAIN_CATEGORIES)) + list(PL.GPS_COLUMNS)
             + list(dict.fromkeys(PL.INTEGER_COLUMNS["main"])) + RANGE_COLS)

# id: (status, formal code, informal code, province, area council, legal status, name)
ESTABLISHMENTS = {
    "01-01-01-01": ("1", "1", "NA", "1", "1", "1", 'Shop "One", Ltd'),
    "01-01-01-02": ("1", "2", "1", "2", "1", "2", "Two"),
    "01-01-01-03": ("1", "NA", "NA", "1", "1", "1", "Three"),
    "01-01-01-04": ("1", "NA", "2", "1", "2", "1", "Four"),
    "01-01-01-05": ("1", "2", "NA", "-999999999", "x", "1", "Five"),
    "01-01-01-06": ("1", "1", "NA", "NA", "2", "2", "Six"),
}
# (id, year code, tot_paid_emp, sales)
ROSTER = [("01-01-01-01", "1", "3", "100.7"), ("01-01-01-01", "2", "4", "200"),
          ("01-01-01-02", "1", "NA", "50"), ("01-01-01-03", "2", "1", "10"),
          ("01-01-01-05", "2", "2", "20"), ("01-01-01-06", "1", "NA", "30")]
RY_INTS = PL.INTEGER_COLUMNS["ref_yearDetails"]
MAIN_MEMBER = next(m for m, table in PL.EXPORT_MEMBERS.items() if table == "main")


def tsv(header, rows):
    return "\t".join(header) + "\n" + "".join("\t".join(r) + "\n" for r in rows)


def main_rows():
    out = []
    for key, (status, formal, informal, prov, area, legal, name) in ESTABLISHMENTS.items():
        vals = {c: "NA" for c in MAIN_COLS}
        vals.update({"interview__key": key, "interview__status": status, "name_businesEsta": name,
                     "major_label_vansic": formal, "major_Infolabel_vanisic": informal,
                     "province": prov, "area_council": area, "legal_status": legal,
                     "account_keeping": "1", "ref_letter": "1", "ref_number": "95",
                     "infor_paidEmp": "1", "business_locate": "2.0", "age": "41.9"})
        out.append([vals[c] for c in MAIN_COLS])
    return out


def export_members():
    ry_header = ["interview__key", "ref_yearDetails__id"] + list(RY_INTS[:5]) + \
        [f"utilities_exp__{i}" for i in range(1, 8)] + list(RY_INTS[5:])
    ry_rows = []
    for key, code, paid, sales in ROSTER:
        vals = {c: "1" for c in ry_header}
        vals.update({"interview__key": key, "ref_yearDetails__id": code, "tot_paid_emp": paid,
                     "sales_goods_services": sales})
        ry_rows.append([vals[c] for c in ry_header])
    acts = [("01-01-01-01", "2022-07-02", "int2", "int2"), ("01-01-01-01", "2022-07-01", "int1", "int1"),
            ("01-01-01-02", "2022-07-01", "int9", "int9"), ("01-01-01-02", "2022-07-03", "int1", "int1"),
            ("01-01-01-03", "2022-07-01", "int2", "int2"), ("01-01-01-05", "2022-07-05", "int1", "int1"),
            ("01-01-01-06", "2022-07-06", "int2", "int2")]
    members = {
        MAIN_MEMBER: tsv(MAIN_COLS, main_rows()),
        "ref_yearDetails.tab": tsv(ry_header, ry_rows),
        "register_id.tab": tsv(["interview__key", "register_id__id"],
                               [("01-01-01-01", "1"), ("01-01-01-01", "2"), ("01-01-01-02", "1")]),
        "interview__actions.tab": tsv(["interview__key", "date", "originator", "responsible__name"],
                                      [(k, d, o, r) for k, d, o, r in acts]),
        "interview__errors.tab": tsv(["interview__key", "variable"],
                                     [("01-01-01-01", "age"), ("01-01-01-01", "sales"),
                                      ("01-01-01-02", "age")]),
        "exp_range.tab": tsv(["interview__key", "exp_utilities"], [("01-01-01-01", "12.5")]),
        "exp_details.tab": tsv(["interview__key", "utilities_cost"], [("01-01-01-01", "300")]),
        "other_cost.tab": tsv(["interview__key", "cost_otherExp"], [("01-01-01-01", "NA")]),
        "other_invest.tab": tsv(["interview__key", "cost_otherInvest"], [("01-01-01-01", "7")]),
        "capital_goods.tab": tsv(["interview__key", "cost_otherCapital"], [("01-01-01-01", "8")]),
    }
    for m in ("finaAcess_roser.tab", "info_activities.tab", "info_other_business.tab", "mobMoney_info.tab"):
        members[m] = tsv(["interview__key", "x__id"], [("01-01-01-01", "1")])
    return members


LISTS = {
    "reference_year": [("1", "2019"), ("2", "2021")],
    "enumerators": [("int1", "Enumerator A"), ("int2", "Enumerator B")],
    "province": [("1", "North"), ("2", "South")],
    "area_council": [("1", "Council A"), ("2", "Council B")],
    "major_label_vansic": [("1", "Mining"), ("2", "Retail")],
    "major_Infolabel_vanisic": [("1", "Retail"), ("2", "Handicraft")],
    "legal_status": [("1", "Sole trader"), ("2", "Company")],
    "ref_letter": [("1", "LS")],
}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("census")
    exp, codes, root = base / "export", base / "codes", base / "warehouse"
    exp.mkdir()
    codes.mkdir()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for m, text in export_members().items():
            zf.writestr(m, text)
    (exp / "export.zip").write_bytes(buf.getvalue())
    for name in CODE_LISTS:
        rows = LISTS.get(name, [("1", f"{name} one")])
        code = "ref_number" if name == "ref_letter" else ("enum" if name == "enumerators" else name)
        desc = "enumdesc" if name == "enumerators" else f"{code}_desc"
        (codes / f"{name}.csv").write_text(f"{code},{desc}\n" + "".join(f"{a},{b}\n" for a, b in rows))
    for name in ("interview_status", "institution_reg", "account_keeping"):
        (codes / f"{name}.csv").write_text(f"{name},{name}_desc\n1,Label one\n2,Label two\n")
    written = PL.run(spark, str(exp), str(codes), str(root), csv_path=str(base / "fieldwork.csv"),
                     id_buckets=4)
    return spark, str(root), written


def mart(run, name):
    spark, root, _ = run
    return read_layer(spark, root, "mart", name)


def test_layers_written(run):
    _, _, written = run
    assert "clean.main" in written and "mart.Table_10" in written and "fieldwork.csv" in written


def test_clean_types_and_drops(run):
    spark, root, _ = run
    main = read_layer(spark, root, "clean", "main")
    types = dict(main.dtypes)
    assert types["age"] == "int" and types["province"] == "string"
    assert types["g4_business_gps__Latitude"] == "double"
    assert not any(c.startswith("busiName_other__") for c in main.columns)
    ry = read_layer(spark, root, "clean", "ref_yearDetails")
    assert not any(c.startswith("utilities_exp__") for c in ry.columns)
    assert {r.id: r.sales_goods_services for r in ry.collect()}["01-01-01-03"] == 10
    assert main.where(F.col("id") == "01-01-01-01").first().age == 41


def test_fieldwork_monitor(run):
    fwm = {r.id: r for r in mart(run, "fwm").collect()}
    # 04 has no action; 02's earliest action is by an unknown originator, so
    # the enumerator join keeps its later one
    assert set(fwm) == {"01-01-01-01", "01-01-01-02", "01-01-01-03", "01-01-01-05", "01-01-01-06"}
    assert fwm["01-01-01-01"].originator == "int1" and fwm["01-01-01-01"].enumdesc == "Enumerator A"
    assert fwm["01-01-01-02"].originator == "int1"
    assert fwm["01-01-01-01"].Reference_Number == "LS 95"


def test_industry_union(run):
    f, i, u = (mart(run, n).count() for n in ("Formal_Industry", "Informal_Industry", "Industry"))
    assert (f, i, u) == (4, 2, 6)


def test_table_1_counts(run):
    t1 = {(r.Industry, r.Reference_Year): r.Number_Of_Establishments for r in mart(run, "Table_1").collect()}
    # 05 has area council 'x' and a sentinel province, 06 no province: both
    # drop in the inner joins; 02 is Retail in both sectors but counts once
    assert t1 == {("Mining", "2019"): 1, ("Mining", "2021"): 1, ("Retail", "2019"): 1}


def test_tables_3_and_4_are_disjoint(run):
    t3 = {tuple(r) for r in mart(run, "Table_3").collect()}
    t4 = {tuple(r) for r in mart(run, "Table_4").collect()}
    # 01 reports 2019 and 2021: its row is the earliest year, so it is in Table_3 only
    assert t3 == {("Mining", "Formal", "2019", "Sole trader"), ("Retail", "Formal", "2019", "Company"),
                  ("Mining", "Formal", "2019", "Company")}
    assert t4 == {("Retail", "Formal", "2021", "Sole trader")}


def test_table_2_sorted_nulls_first(run):
    rows = mart(run, "Table_2").orderBy(F.col("Paid_Emp_Formal").asc_nulls_first()).collect()
    assert rows[0].Paid_Emp_Formal is None


def test_quality_marts(run):
    prov = {r.province: r.total for r in mart(run, "prov_results").collect()}
    assert prov == {"1": 3, "2": 1}
    errs = {r.variable: r.total for r in mart(run, "errors_detect").collect()}
    assert errs == {"age": 2, "sales": 1}
    chart = {r.originator: r.totError for r in mart(run, "chart_errors_by_originator").collect()}
    # interview 01 (2 errors) was touched by int1 and int2; 02 (1 error) by int9 and int1
    assert chart == {"int1": 3, "int2": 2, "int9": 1}


def test_pilot_fanout(run):
    pilot = mart(run, "pilotData").collect()
    assert sorted(r.id for r in pilot) == ["01-01-01-01", "01-01-01-01", "01-01-01-02"]


def test_fieldwork_csv(run):
    _, _, written = run
    parts = sorted(glob.glob(os.path.join(written["fieldwork.csv"], "part-*")))
    lines = "".join(open(p).read() for p in parts).splitlines()
    assert lines[0].startswith('"id","Reference_Number","Business_Name","Major_Label_Vansic"')
    ids = [ln.split(",")[0] for ln in lines[1:]]
    assert ids == sorted(ids)
    assert any('"Shop ""One"", Ltd"' in ln for ln in lines)


def test_table_1_pivot(run):
    piv = {r.Industry: (r["2019"], r["2021"]) for r in mart(run, "Table_1_pivot").collect()}
    assert piv == {"Mining": (1, 1), "Retail": (1, None)}
    tot = {(r.Industry, r.Reference_Year, r.total_level): r.n
           for r in mart(run, "Table_1_pivot_totals").collect()}
    assert tot[(None, None, 3)] == 3 and tot[("Mining", None, 1)] == 2


def test_members_parsed_from_staged_lines_with_pruning(run):
    from fieldstat.sources import read_member, records
    from pyspark.sql import types as T
    spark, root, _ = run
    staged = read_layer(spark, root, "raw", "_export_lines")
    schema = T.StructType([T.StructField("interview__key", T.StringType()),
                           T.StructField("variable", T.StringType())])
    df = read_member(records(staged), "interview__errors.tab", schema, check_header=False)
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(member" in plan


def test_command_line_wires_arguments(monkeypatch, spark):
    seen = {}

    def fake_run(s, archives, codes, root, **kw):
        seen.update(archives=archives, codes=codes, root=root, **kw)
        return {"x": "y"}

    monkeypatch.setattr(PL, "run", fake_run)
    PL.main(["--archives", "A", "--codes", "C", "--root", "R", "--csv", "O", "--id-buckets", "16",
             "--code-format", "parquet"])
    assert seen == {"archives": "A", "codes": "C", "root": "R", "csv_path": "O",
                    "code_format": "parquet", "id_buckets": 16}


def test_dashboard_alone_from_the_clean_layer(run, tmp_path_factory):
    spark, root, _ = run
    codes = tmp_path_factory.mktemp("dash_codes")
    (codes / "province.csv").write_text("province,province_desc\n1,North\n2,South\n")
    written = PL.dashboard(spark, str(codes), root)
    assert set(written) == {"mart.chart_errors_by_originator", "mart.chart_errors_by_variable",
                            "mart.chart_interviews_per_province"}
    chart = {r.originator: r.totError for r in mart(run, "chart_errors_by_originator").collect()}
    assert chart == {"int1": 3, "int2": 2, "int9": 1}
