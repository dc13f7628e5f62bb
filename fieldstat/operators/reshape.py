"""Schema operators: positional rename, positional range drop, bulk casts
(inventory P1, P2, P7).  All are pure projections: no job, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from fieldstat.functions.columns import as_integer, category_text


def rename_first(df: DataFrame, name: str = "id") -> DataFrame:
    """P1 ``colnames(df)[1] <- name``: rename the first column by position."""
    first = df.columns[0]
    if first == name:
        return df
    if name in df.columns:
        raise ValueError(f"column {name!r} already exists; renaming {first!r} would clash")
    return df.withColumnRenamed(first, name)


def range_columns(columns: list[str], first: str, last: str) -> list[str]:
    """Columns from ``first`` to ``last`` inclusive, by position (dplyr ``a:b``)."""
    missing = [c for c in (first, last) if c not in columns]
    if missing:
        raise KeyError(f"range endpoint(s) not found: {missing}")
    i, j = columns.index(first), columns.index(last)
    if i > j:
        i, j = j, i
    return columns[i:j + 1]


def drop_range(df: DataFrame, *ranges: tuple[str, str]) -> DataFrame:
    """P2 ``select(df, -a:-b, -c:-d)``: drop inclusive positional column ranges.

    All ranges are resolved against the input column order first, then
    dropped in one projection.
    """
    cols = df.columns
    doomed: set[str] = set()
    for first, last in ranges:
        doomed.update(range_columns(cols, first, last))
    return df.select(*[c for c in cols if c not in doomed])


_INTEGRAL = ("tinyint", "smallint", "int")


def to_integer(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P7 with X3: ``mutate_at(df, vars(...), as.integer)``.  Columns that
    already are 32-bit integers only lose R's NA sentinel (same result as the
    general conversion, simpler plan)."""
    types = dict(df.dtypes)
    wanted = list(dict.fromkeys(cols))
    missing = [c for c in wanted if c not in types]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    from pyspark.sql import functions as F
    from fieldstat.functions.columns import R_INT_NA

    def conv(c):
        if types[c] in _INTEGRAL:  # only R's NA sentinel changes
            return F.when(F.col(c) != F.lit(R_INT_NA), F.col(c).cast("int"))
        return as_integer(F.col(c), text=types[c] == "string")
    return df.withColumns({c: conv(c) for c in wanted})


def to_category(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P7 with X4: ``mutate_at(df, vars(...), as.factor)``.

    The database stores categories as text.  Numeric columns get R's label
    text (for integer types simply their digits); string columns already are
    their label and are kept as they are.
    """
    types = dict(df.dtypes)
    wanted = list(dict.fromkeys(cols))
    missing = [c for c in wanted if c not in types]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    from pyspark.sql import functions as F
    out = {}
    for c in wanted:
        if types[c] == "string":
            out[c] = F.col(c)
        elif types[c] in _INTEGRAL + ("bigint",):
            out[c] = F.col(c).cast("string")  # an integer's label is its digits
        else:
            out[c] = category_text(F.col(c))
    return df.withColumns(out)
