"""Fieldwork-monitoring marts (inventory R1-R5).

Every function takes ``t``, a mapping of table name to DataFrame with the
census column names (``main``, ``interview_actions``, code lists by list
name, ...), and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstat.functions.columns import (
    minutes_between, parse_time, paste, time_of_day_text, time_text)
from fieldstat.operators.groups import representative_rows
from fieldstat.operators.joins import label_join

Tables = Mapping[str, DataFrame]


def fieldwork_monitor(t: Tables) -> DataFrame:
    """R1 ``fwm``: one row per interviewed establishment with the status,
    one enumerator action (the earliest by date, then originator) and the
    reference number ``paste(Ref_Letter, ref_number)``.

    The enumerator join is on the action side, so actions are reduced to one
    row per ``id`` *before* meeting ``main`` (one row per id): the big log is
    cut down map-side instead of fanning out through the joins.
    """
    actions = t["interview_actions"]
    order = ["date"] + [c for c in ("time", "line_no") if c in actions.columns]
    acts = label_join(actions.select("id", "originator", "responsible__name", *order),
                      t["enumerators"], "originator", "enum", ["enumdesc"])
    acts = representative_rows(acts, "id", order_by=["date", "originator", "responsible__name",
                                                     "enumdesc", *order[1:]])
    m = t["main"].select("id", "interview__status", "ref_letter", "ref_number", "name_businesEsta",
                         "start_time", "start_end_time")
    m = label_join(m, t["interview_status"], "interview__status", "interview_status",
                   ["interview_status_desc"])
    m = label_join(m, t["ref_letter"], "ref_letter", "ref_number",
                   {"ref_number_desc": "Ref_Letter"})
    j = acts.join(m, "id")
    return j.select("id", "interview_status_desc", "originator", "responsible__name", "enumdesc", "date",
                    "start_time", "start_end_time", "Ref_Letter", "ref_number",
                    F.col("name_businesEsta").alias("Business_Name"),
                    paste("Ref_Letter", "ref_number").alias("Reference_Number"))


def interview_durations(fwm: DataFrame) -> DataFrame:
    """The monitor's time columns cleaned and the interview's minutes (X7-X10,
    the chain the reference prepares on ``start_time`` and ``start_end_time``)."""
    start, end = parse_time("start_time"), parse_time("start_end_time")
    return fwm.select("id", time_text("start_time").alias("start_text"),
                      time_of_day_text("start_end_time").alias("end_clock"),
                      start.cast("timestamp_ntz").alias("started"), minutes_between(start, end).alias("minutes"))


def sector(t: Tables, code_col: str, label: str) -> DataFrame:
    """Establishments with a code of one sector classification, the
    label as ``Industry`` and the sector as ``IndustryType``.  Rows without a
    valid code drop (inner join)."""
    m = t["main"].select("id", "name_businesEsta", code_col)
    j = label_join(m, t[code_col], code_col, code_col, {f"{code_col}_desc": "Industry"})
    return j.select("id", "name_businesEsta", "Industry", F.lit(label).alias("IndustryType"))


def formal_industry(t: Tables) -> DataFrame:
    return sector(t, "major_label_vansic", "Formal")


def informal_industry(t: Tables) -> DataFrame:
    return sector(t, "major_Infolabel_vanisic", "Informal")


def industry(t: Tables) -> DataFrame:
    """R4 ``rbind(Formal_Industry, Informal_Industry)``: an establishment with
    both codes appears twice.  Both halves are narrow (a pruned three-column
    scan of ``main`` and a broadcast join each), so the union needs no
    exchange.  A single-pass variant (left-join both lists, explode) was
    rejected: with a duplicated code in one list it would also multiply the
    other sector's rows, which the union of inner joins does not."""
    return formal_industry(t).unionByName(informal_industry(t))


def fieldwork_industry(t: Tables, fwm: DataFrame | None = None,
                       ind: DataFrame | None = None) -> DataFrame:
    """R5 ``fwm_industry``: monitor rows per sector of the establishment, the
    nine published columns.  Sort by ``id`` (then sector) only when writing
    the file (``sinks.quoted_csv``), not here."""
    fwm = fwm if fwm is not None else fieldwork_monitor(t)
    ind = ind if ind is not None else industry(t)
    j = fwm.join(ind.select("id", "Industry", "IndustryType"), "id")
    return j.select("id", "Reference_Number", "Business_Name",
                    F.col("Industry").alias("Major_Label_Vansic"), "IndustryType",
                    "originator", "responsible__name", "enumdesc", "date")
