"""Types of columns that no schema declares, guessed from their text like ``read_delim``.

Every value gets the set of types it can be read as, one bit each; a column's
set is the bitwise AND over its rows.  One aggregate with one long per column
answers for all columns of a table, partial results are combined map-side, and
one row reaches the driver.  The column's type is the first of ``TYPES`` left:
the types form a lattice (a date is also a date-time, everything is text).

readr guesses from a sample of the rows, so a late odd value becomes missing;
here all rows are read, and such a column stays text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts readr reads as logical, and as missing.
LOGICAL = ("T", "F", "TRUE", "FALSE", "true", "false", "True", "False")
MISSING = ("", "NA")

#: Type names in order of preference; a type's bit is 2 to the power of its place.
TYPES = ("boolean", "double", "date", "timestamp_ntz", "string")
_EVERY = (1 << len(TYPES)) - 1

# a whole part with a leading zero is a code, not a number (as in readr)
_NUMBER = r"^[+-]?(?:(?:0|[1-9][0-9]*)(?:[.][0-9]*)?|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]{1,6})?)?$"


def _text(column: str) -> Column:
    return F.btrim(F.col(f"`{column}`"))


def _date(text: Column) -> Column:
    return F.when(text.rlike(_DATE), F.try_to_date(F.replace(text, F.lit("/"), F.lit("-")), "yyyy-M-d"))


def _moment(text: Column) -> Column:
    return F.coalesce(F.when(text.rlike(_MOMENT), text.try_cast("timestamp_ntz")), _date(text).cast("timestamp_ntz"))


def possible_types(column: str) -> Column:
    """Bits of the types that a text value can be read as; all of them for a missing one."""
    text = _text(column)
    fits = (text.isin(*LOGICAL), text.rlike(_NUMBER), _date(text).isNotNull(), _moment(text).isNotNull())
    bits = sum((F.when(fit, 1 << i).otherwise(0) for i, fit in enumerate(fits)), F.lit(1 << len(fits)))
    return F.when(text.isNull() | text.isin(*MISSING), _EVERY).otherwise(bits).cast("long")


def guess_types(df: DataFrame, columns: Iterable[str] | None = None) -> dict[str, str]:
    """Type name of each text column (of ``columns``).  A column without a value stays ``string``."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    wanted = [c for c in text if columns is None or c in set(columns)]
    if not wanted:
        return {}
    found = df.agg(*[F.bit_and(possible_types(c)).alias(f"t{i}") for i, c in enumerate(wanted)]).first()
    out = {}
    for c, bits in zip(wanted, found):
        bits = 1 << len(TYPES) - 1 if bits is None or bits == _EVERY else bits
        out[c] = next(t for i, t in enumerate(TYPES) if bits >> i & 1)
    return out


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns read as the types given, in one projection; ``string`` columns are left as they are."""
    def read(column: str, kind: str) -> Column:
        text = _text(column)
        value = {"boolean": F.upper(F.substring(text, 1, 1)) == "T", "date": _date(text),
                 "timestamp_ntz": _moment(text)}.get(kind, text.try_cast("double"))
        return F.when(~text.isin(*MISSING), value)

    return df.withColumns({c: read(c, t) for c, t in types.items() if t != "string"})


def read_guessed(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``df`` with its text columns (of ``columns``) read as their guessed types."""
    return apply_types(df, guess_types(df, columns))
