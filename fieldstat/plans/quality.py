"""Data-quality and dashboard datasets (inventory R17-R21).

All are counts per a few keys: Spark's partial aggregation combines rows
map-side, so even a key holding a third of the rows ships one partial count
per map task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstat.functions.columns import category_text, positive_code
from fieldstat.operators.groups import bar_data, keep_first
from fieldstat.operators.joins import merge_frames

Tables = Mapping[str, DataFrame]


def interviews_per_province(t: Tables, sort: bool = True) -> DataFrame:
    """R17 ``prov_results``: interviews per province with a positive code
    (F1), merged with the province list by code (J8).  R's ``merge`` matches
    the two keys as text, so the numeric list code gets its R label text."""
    prov = (t["main"].where(positive_code("province"))
            .groupBy("province").agg(F.count("id").alias("total")))
    plist = t["province"].select(category_text("province").alias("province"), "province_desc")
    return merge_frames(prov, plist, "province", sort=sort, spread=False)


def errors_by_variable(t: Tables) -> DataFrame:
    """R18 ``errors_detect``: validation errors per questionnaire variable."""
    return t["errors"].groupBy("variable").agg(F.count("id").alias("total"))


def errors_by_interview(t: Tables) -> DataFrame:
    """R19 ``error_chk``: validation errors per interview."""
    return t["errors"].groupBy("id").agg(F.count("id").alias("totError"))


def first_action(t: Tables) -> DataFrame:
    """R20 ``interviewer``: the first action row of each (interview,
    originator), in source order when a line number is present, else by
    date and time.  ``line_no`` counts over all archives in the raw layer
    (``number_records``); a frame that still has the archive's path with a
    number within each archive is ordered by both."""
    a = t["interview_actions"]
    order = [c for c in ("archive", "line_no", "date", "time") if c in a.columns]
    return keep_first(a, ["id", "originator"], order)


def interviewer_errors(t: Tables, sort: bool = True) -> DataFrame:
    """R21 ``interviewer_error``: each interview's error count next to every
    originator who acted on it (merge by interview key)."""
    return merge_frames(errors_by_interview(t), first_action(t), "id", sort=sort, spread=False)


def errors_by_originator(t: Tables) -> DataFrame:
    """Chart A bars: ``geom_bar(stat = "identity")`` sums ``totError`` per
    originator (A8)."""
    return bar_data(interviewer_errors(t, sort=False), "originator", "totError")
