"""S3: the code-list catalog (one list per workbook sheet in the reference).

Each list arrives as its own CSV or Parquet file ``<dir>/<name>.<fmt>`` with
a code column named like the list and a ``<name>_desc`` label.  Codes are
numeric in the source workbook, so the code column is typed double unless
the list is declared text-coded (``enumerators`` uses login names).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from fieldstat.functions.columns import number
from fieldstat.operators.joins import MAX_BROADCAST_ROWS, checked_broadcast

# The 40 code lists of the census workbook, in workbook order.
CODE_LISTS = (
    "ref_letter", "position", "owner_sex", "owner_character", "employee_sex", "registered",
    "province", "island", "area_council", "institution_reg", "legal_status",
    "place_of_operation", "account_keeping", "reference_year", "major_label_vansic",
    "sub_major_label_vansic", "minor_label_vansic", "unit_label_vansic",
    "vnsic_label_infovansic", "imp_brdclose", "imp_finstatus", "imp_situation",
    "overcome_problem", "operation_Noexp", "informal", "bus_activities",
    "major_Infolabel_vanisic", "sub_majorlabel_info_vanisic", "minor_label_infovansic",
    "unit_label_infovansic", "vansic_label_infovansic", "infor_paidEmp", "unpaid_emp",
    "hhld_business", "hhld_exp", "finance_source", "mobile_money_service",
    "rank_of_services", "interview_status", "enumerators",
)
TEXT_CODED = ("enumerators",)


def load_code_lists(spark: SparkSession, directory: str, names: Iterable[str] | None = None,
                    fmt: str = "csv", text_coded: Iterable[str] = TEXT_CODED,
                    max_broadcast_rows: int | None = MAX_BROADCAST_ROWS) -> dict[str, DataFrame]:
    """``read_excel(path, sheet = name)`` for every list: ``{name: DataFrame}``.

    CSV lists are read as text (no inference) and the code column is
    converted where it is plain decimal text.  All list sizes are checked in one job; lists
    within ``max_broadcast_rows`` carry a broadcast hint into every label join
    (``None`` skips the check and leaves the choice to Spark's statistics).
    """
    text_coded = set(text_coded)
    out = {}
    for name in (names or CODE_LISTS):
        path = f"{directory.rstrip('/')}/{name}.{fmt}"
        if fmt == "csv":
            # only an empty cell is missing: ``NA`` is a label like any other
            df = spark.read.option("header", True).option("escape", '"').csv(path)
        else:
            df = spark.read.format(fmt).load(path)
        code = df.columns[0]
        if name not in text_coded:
            df = df.withColumn(code, number(f"`{code}`"))
        out[name] = df
    if max_broadcast_rows is not None:
        out = checked_broadcast(out, max_broadcast_rows)
    return out
