"""Records of delimited text whose quoted fields hold line breaks, and one number for every record of many archives.

Input are *blocks*: runs of consecutive lines of one member (``archive``,
``member``, ``first_line``, ``n_lines``, ``lines``).  Where a record begins
depends on all quotes before it, so the blocks cannot be cut independently.
It is done as a segmented prefix computation:

1. Each line is a function of one bit (inside a quoted field or not): the bit
   at its end for either bit at its start.  A block composes its lines'
   functions (``with_quote_state``; stored beside the lines, two booleans).
2. The blocks' functions are composed along each member by window functions,
   which gives the bit at every block's start.  Only these booleans are
   shuffled, never the text.
3. Blocks that begin outside a field are cut by themselves.  Those that begin
   inside one (few: their keys are size-checked and broadcast) begin with the
   rest of a record.  The open end of one block and the beginnings that
   continue it meet in a small grouping.

A quote opens a field only at the field's start; inside, a doubled quote is a
quote.  A field that is never closed fails with the member's name instead of
swallowing what follows.

``number_records`` adds ``source_no``: the member's lines in all archives
before this one (by path), plus the line number.  It grows in source order
over all archives, which keep-first (A7) needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstat.operators.joins import bounded_broadcast

QUOTE = '"'
#: States within a line: text, quoted field, after a closing quote, start of a field's line.
_TEXT, _INSIDE, _CLOSED, _START = 0, 1, 2, 3
_KEYS = ["archive", "member", "first_line"]


def _after_line(line: Column, inside: Column, sep: str) -> Column:
    """Whether the end of ``line`` lies inside a quoted field, given its start."""
    parts = F.split(line, QUOTE, -1)

    def next_state(state: Column, part: Column) -> Column:
        """State behind ``part`` and the quote that follows it."""
        opens = part.endswith(sep) | ((state == _START) & (part == ""))
        return (F.when(state == _INSIDE, _CLOSED)
                .when((state == _CLOSED) & (part == ""), _INSIDE)  # a doubled quote
                .otherwise(F.when(opens, _INSIDE).otherwise(_TEXT)))

    first = F.when(inside, _INSIDE).otherwise(_START)
    state = F.aggregate(F.slice(parts, 1, F.size(parts) - 1), first, next_state)
    return F.when(F.contains(line, F.lit(QUOTE)), state == _INSIDE).otherwise(inside)


def with_quote_state(blocks: DataFrame, sep: str = "\t") -> DataFrame:
    """``blocks`` with ``open_out`` and ``open_in``: whether a block ends inside a quoted field when it begins
    outside (inside) one."""
    quoted = F.exists("lines", lambda x: F.contains(x, F.lit(QUOTE)))

    def end(inside: bool) -> Column:
        fold = F.aggregate("lines", F.lit(inside), lambda state, x: _after_line(x, state, sep))
        return F.when(quoted, fold).otherwise(F.lit(inside))

    return blocks.withColumns({"open_out": end(False), "open_in": end(True)})


def block_starts(blocks: DataFrame) -> DataFrame:
    """Keys of every block, ``inside`` (whether it begins inside a quoted field) and ``open`` (whether it ends in one)."""
    b = blocks.select(*_KEYS, "open_out", "open_in")
    along = Window.partitionBy("archive", "member").orderBy("first_line")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    # a block either fixes the bit at its end, flips it or keeps it
    fixes, flips = F.col("open_out") == F.col("open_in"), F.col("open_out") & ~F.col("open_in")
    b = b.withColumn("flipped", F.sum(flips.cast("int")).over(along))
    last = F.last(F.when(fixes, F.struct("open_out", "flipped")), ignorenulls=True).over(before)
    b = b.withColumn("last", last).withColumn("so_far", F.lag("flipped", 1, 0).over(along))
    inside = F.pmod(F.coalesce(F.col("last.open_out").cast("int"), F.lit(0)) + F.col("so_far")
                    - F.coalesce(F.col("last.flipped"), F.lit(0)), F.lit(2)) == 1
    b = b.withColumn("inside", inside)
    return b.select(*_KEYS, "inside", F.when(F.col("inside"), F.col("open_in")).otherwise(F.col("open_out")).alias("open"))


def _begins(sep: str) -> Column:
    """Places (from 0) of the lines that do not begin inside a quoted field.

    One pass over the lines notes a character per line.  The notes are the argument of ``split``, outside any lambda:
    Spark moves a column that is named once to where it is named, and inside a lambda the pass would be made anew for
    every line.
    """
    start = F.struct(F.col("inside").alias("now"), F.lit("").alias("seen"))
    seen = F.aggregate(
        "lines", start,
        lambda a, x: F.struct(_after_line(x, a["now"], sep).alias("now"),
                              F.concat(a["seen"], F.when(a["now"], "1").otherwise("0")).alias("seen")),
        lambda a: a["seen"])
    return F.filter(F.transform(F.split(seen, ""), lambda x, i: F.when(x == "0", i)), lambda i: i.isNotNull())


def records(blocks: DataFrame, sep: str = "\t") -> DataFrame:
    """``archive``, ``member``, ``line_no`` (of the record's first line) and ``line`` (the record, with its line breaks)
    of stored ``blocks`` with their quote state.  Runs one job over the blocks' booleans."""
    starts = block_starts(blocks)
    ends = starts.groupBy("archive", "member").agg(F.max_by("open", "first_line").alias("open"))
    left_open = ends.where("open").select("archive", "member").first()
    if left_open is not None:
        raise ValueError(f"member {left_open['member']!r} of {left_open['archive']!r}: a quoted field is never closed")
    begun = bounded_broadcast(starts.where("inside").select(*_KEYS, F.lit(True).alias("inside")))
    b = blocks.join(begun, _KEYS, "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    plain = b.where(~F.col("inside") & ~F.exists("lines", lambda x: F.contains(x, F.lit(QUOTE))))
    out = plain.select("archive", "member", "first_line", F.posexplode("lines").alias("at", "line"))
    out = out.select("archive", "member", (F.col("first_line") + F.col("at")).alias("line_no"), "line")

    quoted = b.where(F.col("inside") | F.exists("lines", lambda x: F.contains(x, F.lit(QUOTE))))
    quoted = quoted.withColumn("at", _begins(sep)).withColumn("ends", F.when(F.col("inside"), F.col("open_in")).otherwise(F.col("open_out")))
    text = lambda a, z: F.array_join(F.slice("lines", a + 1, z - a), "\n", "")
    n = F.col("n_lines").cast("int")
    whole = F.transform(F.arrays_zip(F.col("at").alias("a"), F.concat(F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))),
                                                                      F.array(n)).alias("z")),
                        lambda r: F.struct(r["a"].alias("at"), text(r["a"], r["z"]).alias("line"), (r["z"] == n).alias("last")))
    whole = F.filter(whole, lambda r: r["at"].isNotNull())  # no line of the block begins a record
    # the beginning that continues a record, and the last record if it stays open, are fragments
    begins = F.when(F.size("at") > 0, F.col("at")[0]).otherwise(n)
    head = F.when(F.col("inside"), F.array(F.struct(F.lit(None).cast("int").alias("at"), text(F.lit(0), begins).alias("line"),
                                                    F.lit(True).alias("last"))))
    head = F.coalesce(head, F.array().cast("array<struct<at:int,line:string,last:boolean>>"))
    pieces = quoted.select(*_KEYS, "ends", F.posexplode(F.concat(head, whole)).alias("order", "r"))
    cut = F.col("r.at").isNull() | (F.col("ends") & F.col("r.last"))
    line_no = F.col("first_line") + F.col("r.at")
    closed = pieces.where(~cut).select("archive", "member", line_no.alias("line_no"), F.col("r.line").alias("line"))
    parts = pieces.where(cut).select("archive", "member", "first_line", "order", line_no.alias("line_no"), F.col("r.line").alias("line"))
    along = Window.partitionBy("archive", "member").orderBy("first_line", "order")
    parts = parts.withColumn("line_no", F.last("line_no", ignorenulls=True).over(along))
    joined = F.array_sort(F.collect_list(F.struct("first_line", "order", "line")))
    parts = parts.groupBy("archive", "member", "line_no").agg(joined.alias("p"))
    parts = parts.select("archive", "member", "line_no", F.array_join(F.col("p.line"), "\n", "").alias("line"))
    every = out.unionByName(closed).unionByName(parts)
    return every.withColumn("line", F.rtrim("line", F.lit("\r")))


def number_records(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """``lines`` (``archive``, ``member``, ``line_no``, ...) with ``source_no``."""
    sizes = blocks.groupBy("archive", "member").agg(F.sum("n_lines").alias("n"))
    earlier = Window.partitionBy("member").orderBy("archive").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("archive", "member", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    found = lines.join(bounded_broadcast(offsets), ["archive", "member"])
    return found.withColumn("source_no", F.col("offset") + F.col("line_no")).drop("offset")
