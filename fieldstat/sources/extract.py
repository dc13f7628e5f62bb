"""The export request restricted one questionnaire version and one
interview status at the source.  Here the restriction is a filter on landed
data; when the raw layer is partitioned by these columns the filter prunes
whole folders instead of reading them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

APPROVED = "ApprovedByHeadquarters"


def extract_status(df: DataFrame, status_col: str, status: str = APPROVED,
                   qnr_col: str | None = None, qnr: str | None = None) -> DataFrame:
    cond = F.col(status_col) == F.lit(status)
    if qnr_col is not None:
        cond = cond & (F.col(qnr_col) == F.lit(qnr))
    return df.where(cond)
