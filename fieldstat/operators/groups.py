"""Grouping operators (inventory A1-A10, F2, F3).

The central one is ``representative_rows``: SQLite lets a query select
columns that are neither grouped nor aggregated and takes all of them from
one arbitrary row of the group.  Spark rejects such SQL, so the choice is made
explicit and deterministic: the first row of the group under a total order
(given tie-break columns, then every remaining column, ascending, nulls
first).  Identical rows tie, but then the output is identical too, so the
result does not depend on partitioning or input order.

``row_number() == 1`` is planned as a partial ``WindowGroupLimit`` before the
exchange: each map task ships at most one row per group, so a hot group
costs no more shuffle than a cold one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstat._util import as_list, to_col

_RN = "__rn"


def _order(df: DataFrame, keys: list[str], order_by) -> list[Column]:
    first = as_list(order_by)
    named = {c for c in first if isinstance(c, str)}
    # every remaining column joins the order, except maps (Spark cannot sort them)
    rest = [f.name for f in df.schema.fields
            if f.name not in keys and f.name not in named and not isinstance(f.dataType, T.MapType)]
    cols = []
    for c in first + rest:
        col = to_col(c) if not isinstance(c, str) else F.col(f"`{c}`")
        # already-ordered Columns (asc/desc) are kept; plain ones go ascending
        cols.append(col if not isinstance(c, str) else col.asc_nulls_first())
    return cols


def representative_rows(df: DataFrame, keys, order_by=None) -> DataFrame:
    """A4: one whole row per group of ``keys``.

    ``order_by`` lists the tie-break columns that decide which row represents
    the group (names sort ascending, nulls first; Column objects are used as
    given); every other non-key column follows, so the order is total up to
    identical rows.  A test on the chosen row (A5, ``HAVING`` on a bare
    column) is a ``where`` on the result; it must stay above the choice.
    """
    keys = as_list(keys)
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*_order(df, keys, order_by))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def keep_first(df: DataFrame, keys, order_by=None) -> DataFrame:
    """A7 dplyr ``distinct(k1, k2, .keep_all = TRUE)``: first whole row per
    key combination, in source order when a line number is given as
    ``order_by``, else by the tie-break columns then the full row."""
    return representative_rows(df, keys, order_by)


def bar_data(df: DataFrame, x, y: str, alias: str | None = None) -> DataFrame:
    """A8/K4 ``geom_bar(stat="identity")`` stacks every row sharing ``x``:
    the dataset a bar shows is the sum of ``y`` per ``x``.  Partial sums are
    combined map-side, so a hot bar is no shuffle hot spot."""
    return df.groupBy(*as_list(x)).agg(F.sum(y).alias(alias or y))


#: Columns a pivot may have; more are refused.
MAX_PIVOT_COLUMNS = 1000


def pivot_values(labels: DataFrame, column: str) -> list:
    """The pivot columns: distinct labels of a code list, sorted.  At most
    ``MAX_PIVOT_COLUMNS + 1`` rows reach the driver; a longer list is refused."""
    found = (labels.select(column).where(F.col(f"`{column}`").isNotNull()).distinct()
             .limit(MAX_PIVOT_COLUMNS + 1).collect())
    if len(found) > MAX_PIVOT_COLUMNS:
        raise ValueError(f"more than {MAX_PIVOT_COLUMNS} pivot columns in {column!r}")
    return sorted(r[0] for r in found)


def crosstab_count(df: DataFrame, rows, col: str, values: list | None = None,
                   weight: str | None = None) -> DataFrame:
    """A9 pivot table, cell = ``n()``: one row per ``rows`` value, one column
    per value of ``col``.  Give ``values`` to avoid the extra distinct job
    Spark otherwise runs to find the columns; ``weight`` names a column of
    counts when ``df`` is already counted.  An empty cell is null."""
    g = df.groupBy(*as_list(rows))
    p = g.pivot(col, values) if values is not None else g.pivot(col)
    return p.agg(F.sum(weight)) if weight else p.count()


def crosstab_totals(df: DataFrame, rows: str, col: str, count_alias: str = "n",
                    weight: str | None = None) -> DataFrame:
    """A10 pivot-table grand totals (pivottabler's default): counts per cell,
    per row, per column and overall, long form.  ``grouping_id`` tells a
    total (``1``/``2``/``3``) from a cell whose key is itself missing (``0``).
    Cells are counted first, so only their counts are expanded into totals;
    ``weight`` names a column of counts when ``df`` is already counted."""
    cells = df.groupBy(rows, col).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("__n"))
    return (cells.cube(rows, col)
            .agg(F.sum("__n").alias(count_alias),
                 F.grouping_id(rows, col).alias("total_level")))


def dense_numbers(df: DataFrame, column: str, number: str = "number") -> DataFrame:
    """Distinct values of ``column`` (missing ones left out) with a number from
    0 without gaps.  Values are numbered within hashed parts, and the parts'
    sizes, of which there are as many as shuffle partitions, are added up; no
    part holds more than its share, and the result depends on the values only.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    c = F.col(f"`{column}`")
    values = df.select(c).where(c.isNotNull()).distinct().withColumn("__part", F.pmod(F.xxhash64(c), F.lit(parts)))
    within = values.withColumn("__rank", F.row_number().over(Window.partitionBy("__part").orderBy(c)))
    sizes = values.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return within.join(F.broadcast(sizes), "__part").select(c, (F.col("__before") + F.col("__rank") - 1).alias(number))


def distinct_totals(df: DataFrame, rows: str, col: str, number: str, count_alias: str = "n") -> DataFrame:
    """A2 with A10: distinct establishments per cell, per row, per column and
    overall, from one pass over the rows; ``total_level`` as in
    ``crosstab_totals``.  Counts of cells cannot be added up to totals, because
    an establishment may lie in several cells; sets of them can.

    ``number`` is a column of whole numbers from 0 (``dense_numbers``; rows
    where it is missing count for nothing).  A cell's set is a bitmap per
    32,768 numbers, built where the rows are; the totals are unions of
    bitmaps.  Numbers without gaps keep the bitmaps full and few.
    """
    n = F.col(f"`{number}`")
    known = df.where(n.isNotNull()).select(F.col(f"`{rows}`").alias("__row"), F.col(f"`{col}`").alias("__col"), n.alias("__n"))
    cells = known.groupBy("__row", "__col", F.bitmap_bucket_number("__n").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__n")).alias("__set"))
    r, c, b = F.col("__row"), F.col("__col"), F.col("__bucket")
    unions = cells.groupingSets([[r, c, b], [r, b], [c, b], [b]], r, c, b).agg(
        F.bitmap_or_agg("__set").alias("__set"), (F.grouping("__row") * 2 + F.grouping("__col")).alias("total_level"))
    counted = unions.groupBy("__row", "__col", "total_level").agg(F.sum(F.bitmap_count("__set")).alias(count_alias))
    return counted.select(F.col("__row").alias(rows), F.col("__col").alias(col), count_alias,
                          F.col("total_level").cast("long").alias("total_level"))
