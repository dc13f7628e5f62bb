"""Line breaks in quoted fields, and record numbers over archives."""

import io
import random
import zipfile

import pytest
from pyspark.sql import types as T

from fieldstat.plans import quality
from fieldstat.sinks.layers import read_layer, write_layer
from fieldstat.sources import explode_blocks, number_records, read_member, records, with_quote_state
from fieldstat.sources.records import block_starts

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
                       T.StructField("n", T.IntegerType())])


def archive(**members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, text in members.items():
            zf.writestr(f"{name}.tab", text)
    return buf.getvalue()


def staged(spark, scratch, archives, block_lines):
    files = spark.createDataFrame(list(archives.items()), "path string, content binary")
    write_layer(with_quote_state(explode_blocks(files, block_lines=block_lines)), scratch, "raw", "lines")
    return read_layer(spark, scratch, "raw", "lines")


def plain_records(text, sep="\t"):
    """(first line, record) by one pass over the characters."""
    out, start, line, inside, field_start, at = [], 0, 0, False, True, 0
    i = 0
    while i < len(text):
        c = text[i]
        if inside:
            if c == '"' and text[i + 1:i + 2] == '"':
                i += 1
            elif c == '"':
                inside = False
        elif c == '"' and field_start:
            inside = True
        elif c == "\n":
            out.append((start, text[at:i].rstrip("\r")))
            at, start = i + 1, line + 1
        field_start = not inside and c in (sep, "\n")
        line += c == "\n"
        i += 1
    if at < len(text):
        out.append((start, text[at:].rstrip("\r")))
    return out


@pytest.mark.parametrize("block_lines", [1, 2, 3, 7, 4096])
def test_records_equal_a_pass_over_the_characters(spark, scratch, block_lines):
    rng = random.Random(block_lines)
    fields = ["x", "", '5" pipe', '"a\nb"', '"""q"" \n\n\t"', '"\n"', 'a"b', '""', '"x"y"z', '"\n\n\n\n\n\n"', "\r", '"é\r\n"']
    texts = {f"{a}.zip": {m: "id\tname\tn\n" + "".join(
        "\t".join(rng.choice(fields) for _ in range(3)) + "\n" for _ in range(60)) for m in ("one", "two")} for a in "ab"}
    blocks = staged(spark, scratch, {a: archive(**m) for a, m in texts.items()}, block_lines)
    got = sorted((r.archive, r.member, r.line_no, r.line) for r in records(blocks).collect())
    want = sorted((a, f"{m}.tab", n, x) for a, ms in texts.items() for m, t in ms.items() for n, x in plain_records(t))
    assert got == want


def test_typed_rows_with_breaks(spark, scratch):
    text = 'id\tname\tn\n1\t"Shop\nBranch ""2"""\t5\n2\tB\t6\r\n\n3\t"\n\n"\t7\n'
    blocks = staged(spark, scratch, {"a.zip": archive(m=text)}, 2)
    rows = read_member(records(blocks), "m.tab", SCHEMA).collect()
    assert sorted((r.id, r.name, r.n, r.line_no) for r in rows) == [
        ("1", 'Shop\nBranch "2"', 5, 1), ("2", "B", 6, 3), ("3", "\n\n", 7, 5)]


def test_a_field_that_is_never_closed_is_named(spark, scratch):
    blocks = staged(spark, scratch, {"a.zip": archive(m='id\tname\tn\n1\t"open\t5\n2\tB\t6\n')}, 2)
    with pytest.raises(ValueError, match="m.tab.*never closed"):
        records(blocks)


def test_only_booleans_are_shuffled_for_the_starts(spark, scratch):
    blocks = staged(spark, scratch, {"a.zip": archive(m="id\tname\tn\n1\tA\t5\n")}, 2)
    scan = [x for x in block_starts(blocks)._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in x]
    assert scan and all("lines:" not in x for x in scan)


def test_first_action_over_two_archives(spark, scratch):
    """The archive's place decides, not the line number within an archive."""
    head = "id\toriginator\tdate\n"
    a = head + "".join(f"x{i}\tint1\t2022-07-03\n" for i in range(4)) + "1\tint1\t2022-01-01\n"
    b = head + "2\tint1\t2022-05-05\n2\tint1\t2022-01-05\n1\tint1\t2022-02-01\n"
    blocks = staged(spark, scratch, {"b.zip": archive(acts=b), "a.zip": archive(acts=a)}, 2)
    schema = T.StructType([T.StructField(c, t) for c, t in (
        ("id", T.StringType()), ("originator", T.StringType()), ("date", T.DateType()))])
    lines = number_records(records(blocks), blocks)
    acts = read_member(lines, "acts.tab", schema).drop("archive")
    first = {r.id: (str(r.date), r.line_no) for r in quality.first_action({"interview_actions": acts}).collect()}
    assert first["1"] == ("2022-01-01", 5) and first["2"] == ("2022-05-05", 7)
    within = read_member(records(blocks), "acts.tab", schema)  # numbers within archives: the path comes first
    first = {r.id: str(r.date) for r in quality.first_action({"interview_actions": within}).collect()}
    assert first["1"] == "2022-01-01" and first["2"] == "2022-05-05"


def test_no_archives(spark, scratch):
    files = spark.createDataFrame([], "path string, content binary")
    write_layer(with_quote_state(explode_blocks(files)), scratch, "raw", "lines")
    blocks = read_layer(spark, scratch, "raw", "lines")
    assert number_records(records(blocks), blocks).count() == 0


def test_states_of_lines_are_computed_once_per_block(spark, scratch):
    """The pass over a block's lines must not lie inside a lambda that runs for every line."""
    blocks = staged(spark, scratch, {"a.zip": archive(m='id\tname\tn\n1\t"A\nB"\t5\n')}, 2)
    plan = records(blocks)._jdf.queryExecution().optimizedPlan()
    nested = []

    def walk(node, inside):
        name = node.getClass().getSimpleName()
        if name == "ArrayAggregate" and inside:
            nested.append(node.toString()[:40])
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i), inside or (name == "LambdaFunction" and "lines#" in node.toString()))

    nodes = [plan]
    while nodes:
        node = nodes.pop()
        nodes.extend(node.children().apply(i) for i in range(node.children().size()))
        found = node.expressions()
        for i in range(found.size()):
            walk(found.apply(i), False)
    assert not nested


def test_long_blocks_cost_in_proportion_to_their_lines(spark, scratch):
    """A block of 4,096 lines that all hold quotes: once a pass per line, 16 million steps."""
    import time

    text = "id\tname\tn\n" + "".join(f'{i}\t"A\n{i}"\t5\n' for i in range(2040))
    blocks = staged(spark, scratch, {"a.zip": archive(m=text)}, 4096)
    began = time.time()
    assert records(blocks).count() == 2041
    assert time.time() - began < 20


def test_archives_of_a_small_table_are_dealt_to_all_tasks(spark, monkeypatch, scratch):
    """One file is one scan task; its archives are unpacked and cut by as many as the session shuffles with."""
    from fieldstat.plans import catalogue

    seen, keep = [], catalogue.explode_blocks
    monkeypatch.setattr(catalogue, "explode_blocks", lambda files, *a: seen.append(files.rdd.getNumPartitions()) or keep(files, *a))
    rows = [(i, f"Customer {i}", i % 25, 1.5, "BUILDING") for i in range(40)]
    columns = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{scratch}/customer.parquet")
    assert catalogue.q_zip_members(spark, scratch).count() == 40
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
