import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstat.sources import (archive_headers, archive_lines, extract_status, load_code_lists, read_delimited,
                               read_member)

MAIN = "interview__key\tprovince\tname\n01-01\t1\tShop A\n01-02\tNA\t\n01-03\t-999999999\tShop \"C\"\n"
ACTS = "interview__key\toriginator\tdate\n01-01\tint1\t2022-07-01\n"
SCHEMA = T.StructType([T.StructField("interview__key", T.StringType()),
                       T.StructField("province", T.DoubleType()),
                       T.StructField("name", T.StringType())])


def make_archive(folder, name, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for m, text in members.items():
            zf.writestr(m, text)
    path = os.path.join(folder, name)
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    return path


def test_archive_scan_reads_named_members(spark, scratch):
    make_archive(scratch, "a.zip", {"main.tab": MAIN, "actions.tab": ACTS})
    make_archive(scratch, "b.zip", {"main.tab": MAIN.splitlines(True)[0] + "02-01\t2\tShop D\n"})
    lines = archive_lines(spark, scratch, members=["main.tab"])
    df = read_member(lines, "main.tab", SCHEMA)
    rows = {r.interview__key: r for r in df.collect()}
    assert set(rows) == {"01-01", "01-02", "01-03", "02-01"}
    assert rows["01-02"].province is None and rows["01-02"].name is None
    assert rows["01-03"].province == -999999999.0
    assert rows["01-03"].line_no == 3


def test_archive_scan_missing_member_and_bad_header(spark, scratch):
    make_archive(scratch, "a.zip", {"main.tab": MAIN})
    lines = archive_lines(spark, scratch)
    with pytest.raises(FileNotFoundError):
        read_member(lines, "nope.tab", SCHEMA)
    bad = T.StructType([T.StructField("x", T.StringType())] * 3)
    with pytest.raises(ValueError):
        read_member(lines, "main.tab", bad)


def test_read_delimited_na_and_empty_are_missing(spark, scratch):
    path = os.path.join(scratch, "main.tab")
    with open(path, "w") as fh:
        fh.write(MAIN)
    df = read_delimited(spark, path, SCHEMA)
    rows = {r.interview__key: r for r in df.collect()}
    assert rows["01-02"].province is None and rows["01-02"].name is None
    assert rows["01-03"].name == 'Shop "C"'


def test_code_list_catalog_types_codes_and_hints_broadcast(spark, scratch):
    with open(os.path.join(scratch, "province.csv"), "w") as fh:
        fh.write("province,province_desc\n1,Torba\n2,Sanma\n")
    with open(os.path.join(scratch, "enumerators.csv"), "w") as fh:
        fh.write("enum,enumdesc\nint1,Person A\n")
    lists = load_code_lists(spark, scratch, ["province", "enumerators"])
    assert dict(lists["province"].dtypes)["province"] == "double"
    assert dict(lists["enumerators"].dtypes)["enum"] == "string"
    plan = lists["province"]._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in plan


def test_extract_status(spark):
    df = spark.createDataFrame([("q$2", "ApprovedByHeadquarters"), ("q$2", "Completed"),
                                ("q$1", "ApprovedByHeadquarters")], "qnr string, status string")
    assert extract_status(df, "status").count() == 2
    assert extract_status(df, "status", qnr_col="qnr", qnr="q$2").count() == 1
    assert extract_status(df, "status", "Completed").where(F.col("qnr") == "q$2").count() == 1


def test_status_extract_prunes_partitioned_layer(spark, scratch):
    from fieldstat.sinks.layers import read_layer, write_layer
    df = spark.createDataFrame([(i, "ApprovedByHeadquarters" if i % 2 else "Completed") for i in range(20)],
                               "id int, interview__status string")
    write_layer(df, scratch, "raw", "main", partition_by=["interview__status"])
    out = extract_status(read_layer(spark, scratch, "raw", "main"), "interview__status")
    assert out.count() == 10
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(interview__status" in plan


def test_header_only_scan_checks_without_reading_data(spark, scratch):
    from fieldstat.sources import archive_headers, check_headers
    make_archive(scratch, "a.zip", {"main.tab": MAIN, "actions.tab": ACTS})
    make_archive(scratch, "b.zip", {"main.tab": MAIN})
    heads = archive_headers(spark, scratch)
    rows = heads.collect()
    assert len(rows) == 3 and all(r.line_no == 0 for r in rows)
    check_headers(heads, {"main.tab": SCHEMA.fieldNames()})
    with pytest.raises(FileNotFoundError):
        check_headers(heads, {"main.tab": SCHEMA.fieldNames(), "nope.tab": ["x"]})
    lines = archive_lines(spark, scratch, members=["main.tab"])
    assert read_member(lines, "main.tab", SCHEMA, headers=heads).count() == 6


def test_archive_lines_split_on_newline_only_and_skip_blank(spark, scratch):
    text = "interview__key\tprovince\tname\r\n01-01\t1\tShop\rA\r\n\r\n01-02\t2\tB\xff\n"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("main.tab", text.encode("latin-1"))
    with open(os.path.join(scratch, "a.zip"), "wb") as fh:
        fh.write(buf.getvalue())
    df = read_member(archive_lines(spark, scratch), "main.tab", SCHEMA)
    rows = {r.interview__key: r for r in df.collect()}
    assert set(rows) == {"01-01", "01-02"}
    assert rows["01-01"].name == "Shop\rA"
    assert rows["01-02"].name == "B�"


def test_members_of_one_archive_are_read_by_different_tasks(spark, scratch):
    """One export of 14 members: 14 tasks, however few archives there are."""
    make_archive(scratch, "a.zip", {f"m{i}.tab": f"id\n{i}\n" for i in range(14)})
    lines = archive_lines(spark, scratch)
    parts = lines.select("member", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(parts) == 14 and len({r.p for r in parts}) == 14
    assert archive_lines(spark, scratch, members=["m3.tab"]).count() == 2


def test_empty_folder_of_archives(spark, scratch):
    make_archive(scratch, "a.zip", {"x.tab": "id\n1\n"})
    assert archive_lines(spark, scratch, members=["y.tab"]).count() == 0


QUOTED = 'interview__key\tprovince\tname\n1\t5\t"The ""Best"" shop"\n2\t6\t"a\\"\n3\t7\t"tab\tin"\n4\t8\tC:\\dir\n'


def test_quoting_rules(spark, scratch):
    """Doubled quotes, a backslash before the closing quote, the separator in quotes: no column shifts."""
    want = {"1": (5.0, 'The "Best" shop'), "2": (6.0, "a\\"), "3": (7.0, "tab\tin"), "4": (8.0, "C:\\dir")}
    with open(os.path.join(scratch, "main.tab"), "w") as fh:
        fh.write(QUOTED)
    make_archive(scratch, "a.zip", {"main.tab": QUOTED})
    for df in (read_delimited(spark, os.path.join(scratch, "main.tab"), SCHEMA),
               read_member(archive_lines(spark, scratch), "main.tab", SCHEMA)):
        assert {r.interview__key: (r.province, r.name) for r in df.collect()} == want


def test_code_list_label_na_is_a_label(spark, scratch):
    with open(os.path.join(scratch, "province.csv"), "w") as fh:
        fh.write('province,province_desc\n1,NA\n2,"The ""North"", all"\n1d,x\n4,\n')
    rows = load_code_lists(spark, scratch, ["province"])["province"].collect()
    assert [tuple(r) for r in rows] == [(1.0, "NA"), (2.0, 'The "North", all'), (None, "x"), (4.0, None)]


def test_read_delimited_bad_value_is_missing(spark, scratch):
    path = os.path.join(scratch, "main.tab")
    with open(path, "w") as fh:
        fh.write("interview__key\tprovince\tname\n01-01\tnot-a-number\tShop A\n01-02\t2\tShop B\n")
    rows = {r.interview__key: r for r in read_delimited(spark, path, SCHEMA).collect()}
    assert rows["01-01"].province is None and rows["01-01"].name == "Shop A"
    assert rows["01-02"].province == 2.0
