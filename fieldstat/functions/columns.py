"""Column expressions for the R-side conversions of the census pipeline.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` only,
so it stays inside whole-stage codegen; none of them is a Python UDF.

Fixed values (must equal R's behaviour for the results to match):
  - missing value text printed by ``paste`` and ``write.csv``: ``NA``
  - ``paste`` separator: one space
  - R's integer NA sentinel: -2147483648 (maps to missing)
  - ``as.Date`` origin: 1970-01-01
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldstat._util import to_col

NA_TEXT = "NA"
R_INT_NA = -2147483648

# Text that reads as a number: plain decimal digits with an optional exponent.
# Spark's cast also takes ``1d``, ``1f``, ``NaN`` and ``Infinity``; neither R
# nor SQLite reads those as a code.
_PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def is_text(col: Column) -> Column:
    """Whether the column is text; folded to a constant when the plan is made."""
    return F.typeof(col) == "string"


def number(col, kind: str = "double", text: bool | None = None) -> Column:
    """``col`` as a number of type ``kind``: text only if it is plain decimal
    text (else missing), numbers as they are.  ``text`` tells which it is where
    the caller knows (a shorter expression to analyse)."""
    c = to_col(col)
    if text is False:
        return c.try_cast(kind)
    plain = c.cast("string").rlike(_PLAIN_NUMBER)
    return F.when(plain if text else ~is_text(c) | plain, c.try_cast(kind))


def paste(*cols, sep: str = " ") -> Column:
    """X1 ``paste(a, b)``: join parts with ``sep``; a missing part prints ``NA``
    and a number prints as R prints it (``95``, not ``95.0``).

    ``concat`` would give null and bare ``concat_ws`` would drop the part.
    """
    parts = [F.coalesce(category_text(c), F.lit(NA_TEXT)) for c in cols]
    return F.concat_ws(sep, *parts)


def epoch_day(col) -> Column:
    """X2 ``as.Date(number)``: day number since 1970-01-01, fraction dropped.
    NaN, infinities and days beyond a 32-bit day number give a missing date (a
    plain cast would throw in ANSI mode, and Spark's ``floor`` maps NaN to 0)."""
    d = number(col)
    ok = (d >= -2147483648.0) & (d < 2147483648.0)  # false for NaN and infinities
    return F.date_from_unix_date(F.when(ok, F.floor(d).cast("int")))


def as_integer(col, text: bool | None = None) -> Column:
    """X3 ``as.integer``: truncate toward zero; unparsable, non-finite or
    out-of-32-bit values become missing, and so does R's NA sentinel.

    Text goes through double first: ``try_cast('3.7' as int)`` is null in
    Spark while R gives 3.
    """
    d = number(col, text=text)
    # one range test: it also excludes R's NA sentinel (-2^31 after
    # truncation), NaN and infinities.  Kept to a single CASE on purpose: a
    # nested form that re-reads the cast result generated code ten times
    # slower (6M rows x 15 columns: 20 s against 2 s).
    return F.when((d > float(R_INT_NA)) & (d < 2147483648.0), d.cast("int"))


def category_text(col) -> Column:
    """X4 ``as.factor``: the category label R would print for a value.

    A double prints 15 significant digits in fixed notation (the reference
    asks for no scientific notation), whole numbers without a point; every
    other type, text included, prints as it is.  Beyond 1e38 the notation stays
    scientific.
    """
    c = to_col(col)
    d = c.try_cast("double")
    whole = (d == F.floor(d)) & (F.abs(d) < 1e15)
    # 15 significant digits, rounded from the exact binary value
    places = F.lit(14) - F.floor(F.log10(F.abs(d))).cast("int")
    shown = F.replace(F.call_function("format_number", d, F.when(F.abs(d) < 1e15, places)), F.lit(","))
    # trailing zeros, then a bare point, trimmed without a regex per row
    fixed = F.rtrim(F.rtrim(shown, F.lit("0")), F.lit("."))
    large = F.format_string("%.14e", d).try_cast("decimal(38,0)").cast("string")
    text = (F.when(whole, d.cast("bigint").cast("string"))
            .when(F.abs(d) >= 1e15, F.coalesce(large, d.cast("string")))
            .otherwise(F.coalesce(fixed, d.cast("string"))))
    floating = F.typeof(c).isin("double", "float") | F.typeof(c).startswith("decimal")
    return F.when(floating, text).otherwise(c.cast("string"))


def fill_missing(col, value) -> Column:
    """X6 ``replace_na``: blank for categories, 0 for numbers (disabled in
    the reference, built as its declared next step)."""
    return F.coalesce(to_col(col), F.lit(value))


def time_text(col) -> Column:
    """X7 ``gsub("T", " ", t)``: every ``T`` becomes a space (disabled in the
    reference)."""
    return F.regexp_replace(to_col(col).cast("string"), "T", " ")


def time_of_day_text(col) -> Column:
    """X8 ``sub(".*?T", "", t)``: drop everything up to the first ``T``
    (disabled in the reference)."""
    return F.regexp_replace(to_col(col).cast("string"), "^[^T]*T", "")


# Which texts each time format is tried on: a format that does not fit costs
# an exception per row.
TIME_FORMATS = {
    r"^[0-9]{4}-[0-9]+-[0-9]+T": "yyyy-M-d'T'H:m:s",
    r"^[0-9]{4}-": "yyyy-M-d H:m:s",
    r"^[0-9]{1,2}/": "M/d/yyyy H:m:s",
    r"^[0-9]{1,2}-": "M-d-yyyy H:m:s",
    r"^[0-9]{1,2}[.]": "M.d.yyyy H:m:s",
}


def parse_time(col, formats: dict[str, str] = TIME_FORMATS) -> Column:
    """X9 ``mdy_hms`` and the ISO form, with or without leading zeros: the
    format whose pattern the text starts with; unparsable text gives null
    (disabled in the reference)."""
    c = to_col(col).cast("string")
    out = F.lit(None).cast("timestamp")
    for start, fmt in reversed(formats.items()):
        out = F.when(c.rlike(start), F.try_to_timestamp(c, F.lit(fmt))).otherwise(out)
    return out


#: Date-time forms a column may have, by name: the texts to try a form on, its pattern, and what is done to the text
#: before.  Of forms that read equally many values the earlier one is taken.
TIME_FORMS = {
    "iso": (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[T ]", "yyyy-M-d H:m:s"),
    "mdy": (r"^[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{4} [0-9:]+$", "M-d-yyyy H:m:s"),
    "dmy": (r"^[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{4} [0-9:]+$", "d-M-yyyy H:m:s"),
    "mdy am/pm": (r"^[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{4} [0-9:]+ ?[AaPp][Mm]$", "M-d-yyyy h:m:s a"),
    "dmy am/pm": (r"^[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{4} [0-9:]+ ?[AaPp][Mm]$", "d-M-yyyy h:m:s a"),
    "mdy short year": (r"^[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{2} [0-9:]+$", "M-d-yy H:m:s"),
    "dmy short year": (r"^[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{2} [0-9:]+$", "d-M-yy H:m:s"),
    "month name first": (r"^[A-Za-z]{3,9} [0-9]{1,2},? [0-9]{4} [0-9:]+$", "MMM d yyyy H:m:s"),
    "month name second": (r"^[0-9]{1,2} [A-Za-z]{3,9},? [0-9]{4} [0-9:]+$", "d MMM yyyy H:m:s"),
}


def read_time(col, form: str) -> Column:
    """Text in one of ``TIME_FORMS`` as a wall-clock timestamp; other text gives null.  Month names count by their
    first three letters, in any case; two-digit years from 69 are of the 20th century, as in lubridate."""
    fits, pattern = TIME_FORMS[form]
    text = F.regexp_replace(F.btrim(to_col(col).cast("string")), r"\s+", " ")
    plain = F.regexp_replace(F.regexp_replace(text, "(?<=[0-9])[/.](?=[0-9]+[-/. ])", "-"), "T", " ") if "MMM" not in pattern else text
    if pattern.endswith(" a"):
        plain = F.upper(F.regexp_replace(plain, "(?i) ?([ap]m)$", " $1"))
    if "MMM" in pattern:
        plain = F.initcap(F.regexp_replace(F.replace(plain, F.lit(","), F.lit("")), "([A-Za-z]{3})[A-Za-z]*", "$1"))
    if " yy" in f" {pattern.split(' ')[0].rsplit('-', 1)[-1]} " and "yyyy" not in pattern:
        year = F.regexp_extract(plain, "-([0-9]{2}) ", 1).try_cast("int")
        century = F.when(year >= 69, "19").otherwise("20")
        plain = F.regexp_replace(plain, F.lit("-([0-9]{2}) "), F.concat(F.lit("-"), century, F.lit("$1 ")))
        pattern = pattern.replace("yy", "yyyy")
    return F.when(text.rlike(fits), F.try_to_timestamp(plain, F.lit(pattern))).cast("timestamp_ntz")


def choose_time_forms(df, columns: list[str]) -> dict[str, str]:
    """The form that reads most values of each column, like ``mdy_hms`` trains on its input, but over all rows: one
    aggregate counts the values each form reads, for all columns at once."""
    counts = [F.count(read_time(F.col(f"`{c}`"), form)).alias(f"{i}:{form}") for i, c in enumerate(columns) for form in TIME_FORMS]
    found = df.agg(*counts).first()
    return {c: max(TIME_FORMS, key=lambda form: found[f"{i}:{form}"]) for i, c in enumerate(columns)}


def parse_times(df, columns: list[str]):
    """``df`` with each column read once, in the form chosen for it."""
    return df.withColumns({c: read_time(F.col(f"`{c}`"), form) for c, form in choose_time_forms(df, columns).items()})


def minutes_between(start, end) -> Column:
    """X10 ``difftime(end, start, units="mins")``: fractional minutes, end
    minus start (disabled in the reference).  Computed on wall-clock
    timestamps, so the result does not depend on the session time zone."""
    s = to_col(start).cast("timestamp_ntz")
    e = to_col(end).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", s, e) / F.lit(60_000_000.0)


def positive_code(col) -> Column:
    """F1 ``WHERE code > 0`` on a text code: missing, blank, negative
    sentinels and non-numbers all fail.  (SQLite compares a text column with
    ``0`` as text, which gives the same answer for numeric codes, blanks and
    sentinels but would let a non-numeric code such as ``'x'`` pass.)"""
    return number(col) > 0


def label_in(col, values) -> Column:
    """F2/F3 ``label = '2019' OR label = '2021'`` with SQLite's comparison: a
    text label equals a value when the texts are equal, a numeric label when
    the value reads as the same number (2019.0 matches '2019')."""
    c = to_col(col)
    values = [str(v) for v in values]
    nums = [float(v) for v in values if _is_number(v)]
    text = c.cast("string").isin(values)
    return F.when(is_text(c), text).otherwise(c.try_cast("double").isin(nums) if nums else F.lit(False))


def _is_number(v: str) -> bool:
    try:
        float(v)
    except ValueError:
        return False
    return True
