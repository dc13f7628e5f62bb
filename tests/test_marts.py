import datetime as dt

import pytest

from fieldstat.plans import marts

TIMES = ("2022-07-01T08:00:00", "2022-07-01T08:30:30")
D1, D2 = dt.date(2022, 7, 1), dt.date(2022, 7, 2)


def tables(spark):
    return {
        "main": spark.createDataFrame(
            [("k1", "1", "1", "95", "Shop A", "1", None, *TIMES), ("k2", "1", "1", "96", "Shop B", None, "1", *TIMES),
             ("k3", "9", "1", "97", "Shop C", "1", "1", *TIMES)],
            "id string, interview__status string, ref_letter string, ref_number string, "
            "name_businesEsta string, major_label_vansic string, major_Infolabel_vanisic string, "
            "start_time string, start_end_time string"),
        "interview_actions": spark.createDataFrame(
            [("k1", "intB", "intB", D1), ("k1", "intA", "intA", D1), ("k1", "intA", "intA", D2),
             ("k2", "intZ", "intZ", D1), ("k2", "intB", "intB", D2), ("k3", "intA", "intA", D1)],
            "id string, originator string, responsible__name string, date date"),
        "enumerators": spark.createDataFrame([("intA", "Person A"), ("intB", "Person B")],
                                             "enum string, enumdesc string"),
        "interview_status": spark.createDataFrame([(1.0, "Approved")],
                                                  "interview_status double, interview_status_desc string"),
        "ref_letter": spark.createDataFrame([(1.0, "LS")], "ref_number double, ref_number_desc string"),
        "major_label_vansic": spark.createDataFrame([(1.0, "Mining")],
                                                    "major_label_vansic double, major_label_vansic_desc string"),
        "major_Infolabel_vanisic": spark.createDataFrame(
            [(1.0, "Retail")], "major_Infolabel_vanisic double, major_Infolabel_vanisic_desc string"),
    }


def test_monitor_row_rule(spark):
    rows = {r.id: r for r in marts.fieldwork_monitor(tables(spark)).collect()}
    # k1: two actions on the first date; the originator breaks the tie
    assert (rows["k1"].originator, rows["k1"].date) == ("intA", D1)
    # k2: the earliest action is by an unknown originator, so the enumerator
    # join leaves the later one
    assert (rows["k2"].originator, rows["k2"].date) == ("intB", D2)
    # k3: status code 9 is not in the status list, so the establishment drops
    assert set(rows) == {"k1", "k2"}
    assert rows["k1"].Reference_Number == "LS 95"


def test_fieldwork_industry_fans_out_per_sector(spark):
    t = tables(spark)
    t["main"] = t["main"].union(spark.createDataFrame(
        [("k4", "1", "1", "98", "Shop D", "1", "1", *TIMES)], t["main"].schema))
    t["interview_actions"] = t["interview_actions"].union(spark.createDataFrame(
        [("k4", "intA", "intA", D1)], t["interview_actions"].schema))
    rows = sorted((r.id, r.IndustryType, r.Major_Label_Vansic)
                  for r in marts.fieldwork_industry(t).collect())
    assert rows == [("k1", "Formal", "Mining"), ("k2", "Informal", "Retail"),
                    ("k4", "Formal", "Mining"), ("k4", "Informal", "Retail")]


def test_durations_and_missing_columns(spark):
    t = tables(spark)
    row = marts.interview_durations(marts.fieldwork_monitor(t)).where("id = 'k1'").first()
    assert (row.start_text, row.end_clock, row.minutes) == ("2022-07-01 08:00:00", "08:30:30", 30.5)
    t["main"] = t["main"].drop("start_time")
    with pytest.raises(Exception, match="start_time"):
        marts.fieldwork_monitor(t)


def test_least_labels_need_no_sort(spark):
    """Tables 1, 3 and 4 keep least labels as numbers: only hash aggregates, and sorts of code lists alone."""
    from fieldstat.plans import marts, reports
    from fieldstat.plans.standins import census_tables
    t = census_tables(spark, "/root/testdata/sf0.001")
    ind = marts.industry(t)
    for df in (reports.establishments_by_industry_year(t, ind, sort=False), reports.legal_status_in_year(t, ind, "1996")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
        assert "WindowGroupLimit" not in plan
