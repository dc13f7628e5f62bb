import datetime as dt
import glob
import os

import pytest

from fieldstat.sinks.layers import layer_path, read_layer, write_layer
from fieldstat.sinks.quoted_csv import csv_document, quoted_csv_lines, write_quoted_csv

ROWS = [
    ("01-20-54-69", 'The "Best" shop', "Trade, retail", 3, 2.5, dt.date(2022, 7, 20)),
    ("02-53-27-40", None, "", None, 1.0, None),
]
SCHEMA = "id string, name string, industry string, n int, x double, date date"


def test_r_csv_line_format(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    lines = sorted(r.value for r in quoted_csv_lines(df).collect())
    assert lines == [
        '"01-20-54-69","The ""Best"" shop","Trade, retail",3,2.5,2022-07-20',
        '"02-53-27-40",NA,"",NA,1,NA',
    ]


def test_csv_document_header_first_and_sorted(spark):
    df = spark.createDataFrame(list(reversed(ROWS)), SCHEMA)
    doc = [r.value for r in csv_document(spark, df, sort_by=["id"]).collect()]
    assert doc[0] == '"id","name","industry","n","x","date"'
    assert doc[1].startswith('"01-') and doc[2].startswith('"02-')


def test_write_quoted_csv_parts_concatenate_to_one_file(spark, scratch):
    df = spark.createDataFrame(ROWS * 3, SCHEMA).repartition(3)
    out = write_quoted_csv(spark, df, os.path.join(scratch, "fw"), sort_by=["id"])
    parts = sorted(glob.glob(os.path.join(out, "part-*")))
    text = "".join(open(p).read() for p in parts)
    lines = text.splitlines()
    assert lines[0] == '"id","name","industry","n","x","date"'
    assert len(lines) == 7 and lines[1:] == sorted(lines[1:])
    assert text.endswith("\n") and "\r" not in text


def test_layers_round_trip_and_reject_unknown_layer(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    write_layer(df, scratch, "raw", "t")
    again = read_layer(spark, scratch, "raw", "t")
    write_layer(again.withColumnRenamed("v", "w"), scratch, "clean", "t")
    assert read_layer(spark, scratch, "clean", "t").columns == ["id", "w"]
    with pytest.raises(ValueError):
        layer_path(scratch, "tmp", "t")


def test_bucketed_layers_join_without_shuffle(spark, scratch):
    a = spark.range(200).selectExpr("id", "id * 2 AS v")
    b = spark.range(200).selectExpr("id", "id * 3 AS w")
    write_layer(a, scratch, "clean", "a_bucketed", bucket_by=["id"], buckets=4)
    write_layer(b, scratch, "clean", "b_bucketed", bucket_by=["id"], buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = read_layer(spark, scratch, "clean", "a_bucketed").join(
            read_layer(spark, scratch, "clean", "b_bucketed"), "id")
        assert j.count() == 200
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with pytest.raises(ValueError):
        write_layer(a, scratch, "clean", "x", bucket_by=["id"])


def test_replacement_is_seen_whole_or_not_at_all(spark, scratch, monkeypatch):
    """A write killed before its commit, at any point, leaves the old table; the next one replaces it."""
    import fieldstat.sinks.layers as L
    old, new = spark.range(5).selectExpr("id", "'old' AS v"), spark.range(9).selectExpr("id", "'new' AS v")
    write_layer(old, scratch, "raw", "t")
    held = read_layer(spark, scratch, "raw", "t")

    failing = new.selectExpr("id", "CASE WHEN id = 8 THEN raise_error('lost') ELSE v END AS v").repartition(4)
    with pytest.raises(Exception, match="lost"):
        write_layer(failing, scratch, "raw", "t")
    assert {r.v for r in read_layer(spark, scratch, "raw", "t").collect()} == {"old"}

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(L, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            write_layer(new, scratch, "raw", "t")
        with pytest.raises(KeyboardInterrupt):
            write_layer(new, scratch, "raw", "t", bucket_by=["id"], buckets=2)
    assert read_layer(spark, scratch, "raw", "t").count() == 5

    write_layer(new, scratch, "raw", "t")
    assert read_layer(spark, scratch, "raw", "t").count() == 9
    assert held.count() == 5  # who read the old version still can
    write_layer(read_layer(spark, scratch, "raw", "t").where("id < 3"), scratch, "raw", "t")  # reads what it replaces
    assert read_layer(spark, scratch, "raw", "t").count() == 3


def test_old_versions_are_dropped_on_request(spark, scratch):
    from fieldstat.sinks.layers import committed_versions, drop_old_versions
    for n in (1, 2, 3):
        write_layer(spark.range(n), scratch, "raw", "t")
    spark.range(7).write.parquet(f"{layer_path(scratch, 'raw', 't')}/v-lost")
    assert len(committed_versions(spark, scratch, "raw", "t")) == 3
    assert len(drop_old_versions(spark, scratch, "raw", "t", keep=2)) == 2
    assert len(committed_versions(spark, scratch, "raw", "t")) == 2
    assert read_layer(spark, scratch, "raw", "t").count() == 3
    assert drop_old_versions(spark, scratch, "raw", "nothing") == []
    with pytest.raises(ValueError):
        drop_old_versions(spark, scratch, "raw", "t", keep=0)
    with pytest.raises(FileNotFoundError):
        read_layer(spark, scratch, "raw", "nothing")


def test_manifest_places_every_part(spark, scratch):
    import glob
    import os

    from fieldstat.sinks.quoted_csv import read_manifest, write_quoted_csv
    df = spark.range(5000).selectExpr("id", 'concat(\'Name "\', id, \'" é\') AS name').repartition(7)
    path = write_quoted_csv(spark, df, f"{scratch}/out.csv", sort_by=["id"])
    parts = read_manifest(spark, path).collect()
    whole = b""
    for p in parts:
        assert p.offset == len(whole)
        data = open(os.path.join(path, p.part), "rb").read()
        assert len(data) == p.bytes
        whole += data
    lines = whole.decode().splitlines()
    assert len(parts) > 2 and len(glob.glob(f"{path}/part-*")) == len(parts)
    assert lines[0] == '"id","name"' and [int(x.split(",")[0]) for x in lines[1:]] == list(range(5000))
