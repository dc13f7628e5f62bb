"""Joins of the census pipeline (inventory J1-J8, F4).

Code lists are small by nature (tens to hundreds of codes), but that is a
property of the data, not something Spark can assume.  Sizes are checked
once, where a catalog is loaded (``checked_broadcast``): a list within the
bound gets a broadcast hint, a larger one none, and then Spark's own size
statistics (static file size, AQE runtime sizes) pick the join.  Label joins
inherit the hint from the list, so they never re-check or re-scan it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstat._util import as_list
from fieldstat.functions.columns import number

# A code list larger than this (rows, or bytes of its rows as JSON text) is
# joined by shuffle instead of broadcast.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def checked_broadcast(frames: dict[str, DataFrame], max_rows: int = MAX_BROADCAST_ROWS,
                      cache: bool = False,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> dict[str, DataFrame]:
    """Size-check several small frames in **one** job and hint a broadcast on
    those within ``max_rows`` rows and ``max_bytes`` bytes (measured as the
    JSON text of the rows, an upper estimate of their size); larger ones are
    returned unhinted.

    Each frame contributes at most ``max_rows + 1`` rows to the check, so its
    cost is bounded however large a frame turns out to be.  ``cache=True``
    keeps frames that are derived by an aggregation (for example a list of
    distinct years) in memory, so the check and the joins share one
    computation; a lost executor only means recomputing them from lineage.
    """
    if not frames:
        return {}
    if cache:
        frames = {k: v.cache() for k, v in frames.items()}
    probes = [v.limit(max_rows + 1).select(
        F.lit(k).alias("frame"),
        F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in v.columns]))).alias("bytes"))
        for k, v in frames.items()]
    sizes = {r["frame"]: (r["n"], r["bytes"] or 0) for r in
             reduce(DataFrame.unionByName, probes).groupBy("frame")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()}
    out = {}
    for k, v in frames.items():
        n, size = sizes.get(k, (0, 0))
        if n <= max_rows and size <= max_bytes:
            out[k] = F.broadcast(v)
        else:
            if cache:
                v.unpersist()
            out[k] = v
    return out


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the frame has at most ``max_rows`` rows."""
    return checked_broadcast({"frame": df}, max_rows)["frame"]


def guarded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint on a list that is derived in the same query, without a job of its own: the list counts its rows
    as it is computed, and more than ``max_rows`` stop the query with a message (join such a list without a hint)."""
    n = F.count(F.lit(1)).over(Window.partitionBy())
    message = f"a list of more than {max_rows} rows cannot be broadcast: join it without a hint"
    counted = df.withColumn("__rows", n).where(F.when(F.col("__rows") <= max_rows, True).otherwise(
        F.raise_error(F.lit(message)).cast("boolean")))
    return F.broadcast(counted.drop("__rows"))


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def code_key(df: DataFrame, col: str, other: DataFrame, other_col: str) -> tuple[Column, Column]:
    """Join key expressions with SQLite's comparison rule for codes.

    Keys of one kind (two texts, two whole numbers, two doubles) compare
    directly, so nothing is rounded and bucketing stays usable.  A text key
    meets a numeric list as a number ('3' = 3.0, 'x' and '1d' match nothing):
    exactly (decimal) against whole numbers, as a double against doubles.
    """
    lt, rt = dict(df.dtypes)[col], dict(other.dtypes)[other_col]
    if "string" not in (lt, rt) or lt == rt:
        return df[col], other[other_col]
    kind = "decimal(38,18)" if {lt, rt} & set(_WHOLE) else "double"
    return number(df[col], kind, lt == "string"), number(other[other_col], kind, rt == "string")


def label_join(df: DataFrame, codes: DataFrame, left_key: str, code_col: str,
               labels: dict[str, str] | list[str] | str, how: str = "inner",
               check_size: bool = False) -> DataFrame:
    """J1/J4 ``INNER JOIN list ON fact.code = list.code``: add label columns.

    ``labels`` maps code-list columns to output names (or lists them to keep
    their names); an output name equal to an input column, ignoring case,
    replaces that column.  Rows whose code is missing or unknown drop (F4); use
    ``unmatched_codes`` to see them.  A list from a loaded catalog carries its
    broadcast hint (size checked at load), so the fact side is not shuffled
    for a label; ``check_size=True`` checks an unchecked list here.
    """
    if isinstance(labels, str):
        labels = [labels]
    if not isinstance(labels, dict):
        labels = {c: c for c in labels}
    # list columns get positional names, so the code column may also be
    # asked for as a label and nothing clashes with the fact side
    src_cols = [code_col, *labels.keys()]
    small = codes.select(*[F.col(f"`{c}`").alias(f"__code_{i}") for i, c in enumerate(src_cols)])
    if check_size:
        small = bounded_broadcast(small)
    lk, rk = code_key(df, left_key, small, "__code_0")
    joined = df.join(small, lk == rk, how)
    # Spark resolves names case-insensitively: a label named like an input
    # column (code ``area_council``, label ``Area_Council``) replaces it.
    taken = {dst.lower() for dst in labels.values()}
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return joined.select(*keep, *[F.col(f"__code_{i + 1}").alias(dst)
                                  for i, dst in enumerate(labels.values())])


def unmatched_codes(df: DataFrame, codes: DataFrame, left_key: str, code_col: str) -> DataFrame:
    """F4 diagnostic: the rows an inner label join silently drops (missing,
    blank, unknown or non-numeric code)."""
    small = codes.select(F.col(code_col).alias("__code"))
    lk, rk = code_key(df, left_key, small, "__code")
    return df.join(small, lk == rk, "left_anti")


def exists_join(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """The reference joins ``main`` only for existence and then groups, so
    an ``INNER JOIN`` equals a semi join here.  Only the key columns of
    ``other`` are read."""
    keys = as_list(on)
    return df.join(other.select(*keys), keys, "left_semi")


def code_combinations(df: DataFrame, lists: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """F4 for several code lists at once: which lists do not know a row's code,
    counted per combination (``unmatched``: the lists' names in the order
    given, ``n_lists``, ``n`` rows).

    ``lists``: name -> (code column of ``df``, list, its code column).  Each
    list sets one bit per row through a broadcast join (sizes checked in one
    job), so the table is scanned once for all of them and only the
    combinations that occur are shuffled.
    """
    keys, codes = {}, {}
    for i, (name, (column, codelist, code)) in enumerate(lists.items()):
        small = codelist.select(F.col(f"`{code}`").alias("__code"))
        keys[name], known = code_key(df, column, small, "__code")
        codes[name] = small.select(known.alias(f"__known_{i}")).where(f"__known_{i} IS NOT NULL").distinct()
    codes = checked_broadcast(codes)
    needed = [F.col(f"`{c}`") for c in dict.fromkeys(column for column, _, _ in lists.values())]
    out = df.select(*needed, *[keys[name].alias(f"__key_{i}") for i, name in enumerate(lists)])
    mask = F.lit(0).cast("long")
    for i, name in enumerate(lists):
        out = out.join(codes[name], F.col(f"__key_{i}") == F.col(f"__known_{i}"), "left")
        mask = mask + F.when(F.col(f"__known_{i}").isNull(), 1 << i).otherwise(0)
    counted = out.groupBy(mask.alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    names = [F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.lit(name)) for i, name in enumerate(lists)]
    return counted.select(F.concat_ws(",", *names).alias("unmatched"), F.bit_count("mask").alias("n_lists"), "n")


def unmatched_per_list(combinations: DataFrame) -> DataFrame:
    """Rows each list does not know (``list_name``, ``n``), from ``code_combinations``."""
    each = combinations.where("n_lists > 0").select(F.explode(F.split("unmatched", ",")).alias("list_name"), "n")
    return each.groupBy("list_name").agg(F.sum("n").alias("n"))


#: Rows of one side that meet a block of the other side's rows together, for a hot key in ``merge_frames``.
BLOCK_ROWS = 256
#: Cells of hot keys, and tasks they are dealt to in turn, for each of the session's shuffle partitions: the last tasks do
#: not keep the others' cores idle for long, and a file of the result holds few cells, so few values.
CELLS = 2


def hot_keys(x: DataFrame, y: DataFrame, keys: list[str], tasks: int) -> DataFrame:
    """Keys whose pairs exceed a task's even share of all pairs, with the grid
    they are joined on: ``__a`` parts of ``x`` by ``__b`` parts of ``y``, in
    cells that are numbered over all these keys, from ``__first`` on.

    Counts are exact, missing keys are a key like any other, and fewer than
    ``tasks`` keys can exceed the share, whatever the size of the data.
    """
    named = [F.col(f"`{k}`").alias(f"__hot_{i}") for i, k in enumerate(keys)]
    sides = x.select(*named, F.lit(1).alias("__nx"), F.lit(0).alias("__ny")).unionByName(
        y.select(*named, F.lit(0).alias("__nx"), F.lit(1).alias("__ny")))
    counts = sides.groupBy(*[f"__hot_{i}" for i in range(len(keys))]).agg(
        F.sum("__nx").cast("double").alias("nx"), F.sum("__ny").cast("double").alias("ny"))
    pairs = F.col("nx") * F.col("ny")
    total = counts.agg(F.sum(pairs).alias("total"))
    hot = counts.where("nx > 0 AND ny > 0").crossJoin(F.broadcast(total)).where(pairs * tasks > F.col("total"))
    cells = F.ceil(pairs * tasks * CELLS / F.col("total"))
    a = F.least(F.greatest(F.ceil(F.sqrt(cells * F.col("nx") / F.col("ny"))), F.lit(1)), cells)
    grid = hot.select(*[F.col(f"__hot_{i}").alias(k) for i, k in enumerate(keys)], a.cast("int").alias("__a"),
                      F.ceil(cells / a).cast("int").alias("__b"))
    # missing keys last: a column that begins with missing values is stored without a dictionary
    before = Window.orderBy(*[F.col(f"`{k}`").isNull() for k in keys], *[F.col(f"`{k}`") for k in keys])
    size = F.col("__a") * F.col("__b")
    return grid.withColumn("__first", (F.sum(size).over(before.rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - size).cast("int"))


def _with_hot(df: DataFrame, hot: DataFrame, keys: list[str], how: str) -> DataFrame:
    listed = hot.select(*[F.col(f"`{k}`").alias(f"__hot_{i}") for i, k in enumerate(keys)], "__a", "__b", "__first")
    return df.alias("__r").join(F.broadcast(listed), reduce(Column.__and__, [
        F.col(f"__r.`{k}`").eqNullSafe(F.col(f"__hot_{i}")) for i, k in enumerate(keys)]), how)


def _on_grid(df: DataFrame, hot: DataFrame, keys: list[str], mine: str, other: str) -> DataFrame:
    """Rows of hot keys: each in one of its side's parts, once for every part of the other side (``__cell``: their number)."""
    hashed = [F.col(f"__r.`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    part = F.coalesce(F.pmod(F.xxhash64(*hashed), F.col(mine)).cast("int"), F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
    placed = _with_hot(df, hot, keys, "inner").select("__r.*", "__b", "__first", part.alias(f"__part{mine}"),
                                                      copies.alias(f"__part{other}"))
    cell = F.col("__first") + F.col("__part__a") * F.col("__b") + F.col("__part__b")
    return placed.withColumn("__cell", cell).drop("__b", "__first")


def _blocks(cells: DataFrame, columns: list[str], tasks: int) -> DataFrame:
    """Rows on the grid as arrays of at most ``BLOCK_ROWS`` rows of a cell, ``columns`` named ``_0``, ``_1``, ... .

    Cells are dealt in turn to a given number of tasks.  All cells of a key have about as many pairs, so tasks get even
    shares; hashed, some tasks would get several cells and others none, and Spark would merge cells, small as they are to
    read, although they are large to join."""
    row = F.struct(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)] or [F.lit(0).alias("_0")])
    place = F.row_number().over(Window.partitionBy("__cell").orderBy("__cell"))
    rows = cells.select("__cell", row.alias("__row")).repartitionById(tasks * CELLS, "__cell")
    return rows.withColumn("__n", F.floor((place - 1) / BLOCK_ROWS)).groupBy("__cell", "__n").agg(
        F.collect_list("__row").alias("__rows")).drop("__n")


def _hot_pairs(x: DataFrame, y: DataFrame, hot: DataFrame, keys: list[str], y_rest: list[str], tasks: int) -> DataFrame:
    """Pairs of rows with a hot key, as structs ``__x`` (all columns of ``x``) and ``__y`` (``y_rest``).

    Blocks are joined, then opened: all pairs of two blocks follow each other.
    A stored result so repeats few values at a time, which its encoding keeps
    small; the pairs of a key differ in little else.
    """
    left = _blocks(_on_grid(x, hot, keys, "__a", "__b"), x.columns, tasks).alias("__x")
    right = _blocks(_on_grid(y, hot, keys, "__b", "__a"), y_rest, tasks).alias("__y")
    met = left.hint("merge").join(right, F.col("__x.__cell") == F.col("__y.__cell")).select(
        F.col("__x.__rows").alias("__xs"), F.col("__y.__rows").alias("__ys"))
    # a lambda is not compiled into one loop with the join: that loop would hold every pair of a block of x in memory
    opened = met.select(F.explode(F.transform("__xs", lambda r: r)).alias("__x"), "__ys")
    return opened.select("__x", F.explode("__ys").alias("__y"))


def merge_frames(x: DataFrame, y: DataFrame, by, suffixes=(".x", ".y"),
                 sort: bool = True, spread: bool = True) -> DataFrame:
    """J8 R ``merge(x, y, by)``: inner join on shared key names where a
    missing key matches a missing key; output is the key, then the rest of
    ``x``, then the rest of ``y``; clashing names get ``.x``/``.y``; rows
    sorted by the key (``sort=False`` skips the global sort).  Keys of
    different types are matched as text, like R.

    A key that many rows of both sides have (the missing key too) makes the
    product of their numbers.  Such keys are counted exactly (``hot_keys``) and
    joined on a grid: one side's rows are split into parts that meet every part
    of the other side, each pair of parts in a cell of its own.  Rows that are
    equal in every column stay in one part.  In a cell, blocks of rows meet
    (``_hot_pairs``).  Rows of all other keys join as usual.

    ``spread=False`` is for merges in which one side has few rows of any key
    (one side grouped by it): no count is made.  Keys that are present then
    join by ``=``, which keeps any partitioning or bucketing by the key, and
    rows with a missing key part on their own by ``<=>`` (their filter reaches
    the scans).
    """
    keys = as_list(by)
    # R matches keys of different types as text (``match`` coerces to
    # character); an implicit Spark cast would throw on a dirty key in ANSI mode
    xt, yt = dict(x.dtypes), dict(y.dtypes)
    mixed = [k for k in keys if xt[k] != yt[k]]
    if mixed:
        from fieldstat.operators.reshape import to_category
        x, y = to_category(x, mixed), to_category(y, mixed)
    x_rest = [c for c in x.columns if c not in keys]
    y_rest = [c for c in y.columns if c not in keys]
    clash = set(x_rest) & set(y_rest)

    def pairs(left: DataFrame, right: DataFrame, same) -> DataFrame:
        cond = reduce(Column.__and__, [same(F.col(f"__x.`{k}`"), F.col(f"__y.`{k}`")) for k in keys])
        cols = [F.col(f"__x.`{k}`").alias(k) for k in keys]
        cols += [F.col(f"__x.`{c}`").alias(c + suffixes[0] if c in clash else c) for c in x_rest]
        cols += [F.col(f"__y.`{c}`").alias(c + suffixes[1] if c in clash else c) for c in y_rest]
        return left.alias("__x").join(right.alias("__y"), cond, "inner").select(*cols)

    if spread:
        tasks = int(x.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = hot_keys(x, y, keys, tasks)
        out = pairs(_with_hot(x, hot, keys, "left_anti"), _with_hot(y, hot, keys, "left_anti"), Column.eqNullSafe)
        fields = [f"__x._{x.columns.index(c)}" for c in [*keys, *x_rest]] + [f"__y._{i}" for i in range(len(y_rest))]
        out = out.unionByName(_hot_pairs(x, y, hot, keys, y_rest, tasks).select(
            *[F.col(f).alias(c) for f, c in zip(fields, out.columns)]))
    else:
        out = pairs(x, y, Column.__eq__)
    if not spread and any(x.schema[k].nullable and y.schema[k].nullable for k in keys):
        missing = reduce(Column.__or__, [F.col(f"`{k}`").isNull() for k in keys])
        out = out.unionByName(pairs(x.where(missing), y.where(missing), Column.eqNullSafe))
    if sort:
        # the other columns only break ties: rows of a key that holds much of
        # the data can then be sorted by several tasks
        rest = [f.name for f in out.schema.fields if f.name not in keys and not isinstance(f.dataType, T.MapType)]
        out = out.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in [*keys, *rest]])
    return out
