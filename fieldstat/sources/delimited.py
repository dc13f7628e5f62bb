"""Typed delimited reads (``read_delim``, ``read.csv``).

Types are declared, never inferred; ``enforceSchema=False`` makes Spark
check the header names against the declared schema.  ``""`` and ``NA`` both
read as missing, as in readr.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t",
                   null_value: str = "NA", header: bool = True,
                   mode: str = "PERMISSIVE") -> DataFrame:
    """A field that does not parse as its declared type reads as missing
    (``PERMISSIVE``, as readr gives NA with a warning); ``mode="FAILFAST"``
    stops at the first such row instead."""
    df = (spark.read.schema(schema)
          .option("sep", sep).option("header", header).option("enforceSchema", not header)
          .option("nullValue", null_value).option("mode", mode)
          .option("escape", '"')  # a quote is doubled; a backslash is an ordinary character
          .csv(path))
    return df.withColumns({f.name: F.when(F.col(f"`{f.name}`") != "", F.col(f"`{f.name}`"))
                           for f in schema.fields if isinstance(f.dataType, T.StringType)})
