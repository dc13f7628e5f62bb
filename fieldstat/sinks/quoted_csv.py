"""K3: R ``write.csv(df, path, row.names = FALSE)`` format.

Header line of quoted names; text values quoted with inner quotes doubled;
numbers, dates and logicals bare; missing values as ``NA``; ``\\n`` line end.
``DataFrameWriter.csv`` only quotes all-or-minimal, so each line is built as
a Column expression and written with ``write.text``: no Python per row.

Fixed values (R's output format): quote ``"``, separator ``,``, missing ``NA``,
logicals ``TRUE``/``FALSE``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstat.functions.columns import NA_TEXT, category_text

QUOTE = '"'
#: Added to a document's path: the file with the manifest of its parts.
MANIFEST = ".manifest.json"
SEP = ","


def _quoted(c: Column) -> Column:
    return F.concat(F.lit(QUOTE), F.replace(c, F.lit(QUOTE), F.lit(QUOTE * 2)), F.lit(QUOTE))


def _field(name: str, dtype: str) -> Column:
    c = F.col(f"`{name}`")
    if dtype == "string":
        text = _quoted(c)
    elif dtype == "boolean":
        text = F.when(c, F.lit("TRUE")).otherwise(F.lit("FALSE"))
    elif dtype in ("double", "float") or dtype.startswith("decimal"):
        text = category_text(c)
    elif dtype == "date":
        text = F.date_format(c, "yyyy-MM-dd")
    elif dtype.startswith("timestamp"):
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NA_TEXT))


def csv_header_line(df: DataFrame) -> str:
    return SEP.join(QUOTE + c.replace(QUOTE, QUOTE * 2) + QUOTE for c in df.columns)


def quoted_csv_lines(df: DataFrame, name: str = "value") -> DataFrame:
    """One string column holding each row's CSV line (no header)."""
    fields = [_field(n, t) for n, t in df.dtypes]
    return df.select(F.concat_ws(SEP, *fields).alias(name))


def csv_document(spark: SparkSession, df: DataFrame, sort_by=None, name: str = "value") -> DataFrame:
    """Header line followed by the data lines, as one DataFrame of lines.

    With ``sort_by`` the lines are range-partitioned and sorted by those
    columns (the published file is sorted by ``id``); the header is the first
    partition, so concatenating the part files in order gives one valid file.
    """
    data = df.orderBy(*sort_by) if sort_by else df
    header = spark.createDataFrame([(csv_header_line(df),)], f"{name} string")
    return header.unionByName(quoted_csv_lines(data, name))


def csv_manifest(spark: SparkSession, path: str) -> list[dict]:
    """Where each part file of a written document lies in the whole: ``part``,
    ``offset`` (bytes of the parts before it) and ``bytes``, in order.  Parts
    can be copied to their offsets of one file, or served as ranges of it, side
    by side; nothing passes through one task."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    out, offset = [], 0
    for part, size in found:
        out.append({"part": part, "offset": offset, "bytes": size})
        offset += size
    return out


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The stored manifest (``part``, ``offset``, ``bytes``) of a document."""
    return spark.read.schema("part string, offset bigint, bytes bigint").json(f"{path.rstrip('/')}{MANIFEST}").orderBy("offset")


def write_quoted_csv(spark: SparkSession, df: DataFrame, path: str, sort_by=None,
                     single_file: bool = False) -> str:
    """Write the R-format CSV as part files in order (header in the first) with
    a manifest of their offsets beside it (``read_manifest``), so that any number of
    parts is one document.  ``single_file=True`` funnels everything through one
    task and is meant for small published extracts only."""
    lines = csv_document(spark, df, sort_by)
    if single_file:
        lines = lines.coalesce(1)
    lines.write.mode("overwrite").option("lineSep", "\n").text(path)
    record = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}{MANIFEST}")
    out = record.getFileSystem(spark._jsc.hadoopConfiguration()).create(record, True)
    out.write(bytearray("".join(json.dumps(r) + "\n" for r in csv_manifest(spark, path)).encode()))
    out.close()
    return path
