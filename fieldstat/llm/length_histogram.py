"""Exact length histogram of encoded documents.

Documents are encoded once and counted by length.  The histogram has at most
one row per length and is what every later question reads: suffix sums over it
answer, for every context limit, how many tokens remain when longer documents
are cut to the limit, how many documents are cut, and the quantiles.

The sums run in two levels (blocks of ``BLOCK`` lengths, then within a block),
so no task holds more than a block or the list of blocks.

Defined results: a null or empty text has length 0 (a row of its own);
repeated rows count each; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import slices, stored, text_bytes
from .tokens import encoder

#: Lengths in one block of the two-level sums.
BLOCK = 1024


def _lengths(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for part in slices(batches):
            lengths = [len(encode(b.decode("utf-8", "replace"))) for b in part.column("body").to_pylist()]
            distinct, counts = np.unique(np.array(lengths, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(counts.astype(np.int64))], ["length", "n"])

    return run


def histogram(docs: DataFrame, vocabulary: str) -> DataFrame:
    """length, n_docs: how many texts of ``docs`` have each encoded length."""
    counted = docs.select(text_bytes().alias("body")).mapInArrow(_lengths(vocabulary), "length long, n long")
    return counted.groupBy("length").agg(F.sum("n").alias("n_docs"))


def context_limits(counts: DataFrame) -> DataFrame:
    """Suffix sums of a histogram, one row per occurring length taken as context limit.

    docs_over / tokens_over: documents longer than the limit and their tokens;
    docs_within: documents that fit; truncated_total: tokens left when every
    document is cut to the limit; total_tokens: uncut; quantile: share of
    documents that fit.  Between two rows, truncated totals follow from the
    lower row: truncated_total + (limit - length) * docs_over.
    """
    block = counts.withColumn("block", F.floor(F.col("length") / BLOCK))
    tokens = F.col("length") * F.col("n_docs")
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = block.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    sums = sums.select(
        "block", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(whole).alias("docs"), F.sum("t").over(whole).alias("total_tokens"))
    inner = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    rows = block.select(
        "block", "length", "n_docs", F.coalesce(F.sum("n_docs").over(inner), F.lit(0)).alias("d_inner"),
        F.coalesce(F.sum(tokens).over(inner), F.lit(0)).alias("t_inner")).join(sums, "block")
    rows = rows.withColumn("docs_over", F.col("d_above") + F.col("d_inner")).withColumn(
        "tokens_over", F.col("t_above") + F.col("t_inner"))
    within = F.col("docs") - F.col("docs_over")
    return rows.select(
        F.col("length").alias("context_limit"), "n_docs", within.alias("docs_within"), "docs_over", "tokens_over",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).alias("truncated_total"),
        "total_tokens", (within / F.col("docs")).alias("quantile"))


def quantiles(limits: DataFrame, shares: list[float]) -> DataFrame:
    """share, length: the smallest length that at least each share of the documents fits in."""
    wanted = [F.min(F.when(F.col("quantile") >= s, F.col("context_limit"))).alias(f"q{i}") for i, s in enumerate(shares)]
    pairs = F.array(*[F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("length")) for i, s in enumerate(shares)])
    return limits.agg(*wanted).select(F.inline(pairs))


def at_limits(limits: DataFrame, values: list[int]) -> DataFrame:
    """Rows like those of ``limits`` for ``values`` that aren't among its lengths (n_docs 0); none for an empty table."""
    values = sorted(set(values))
    if not values:
        return limits.limit(0)
    length, n = F.col("context_limit"), F.col("n_docs")
    over = lambda v, x: F.coalesce(F.sum(F.when(length > v, x)), F.lit(0))
    sums = limits.agg(F.sum(n).alias("docs"), F.max("total_tokens").alias("total_tokens"), *[
        F.struct(F.lit(v).cast("long").alias("context_limit"), over(v, n).alias("docs_over"), over(v, length * n).alias("tokens_over"),
                 F.coalesce(F.max(length == v), F.lit(False)).alias("occurs")).alias(f"v{i}") for i, v in enumerate(values)])
    rows = sums.filter("docs > 0").select("docs", "total_tokens", F.inline(F.array(*[f"v{i}" for i in range(len(values))])))
    within = F.col("docs") - F.col("docs_over")
    return rows.filter(~F.col("occurs")).select(
        length, F.lit(0).cast("long").alias("n_docs"), within.alias("docs_within"), "docs_over", "tokens_over",
        (F.col("total_tokens") - F.col("tokens_over") + length * F.col("docs_over")).alias("truncated_total"),
        "total_tokens", (within / F.col("docs")).alias("quantile"))


def with_shares(limits: DataFrame, shares: list[float]) -> DataFrame:
    """``limits`` with ``shares``: those of ``shares`` (above 0) whose quantile, as by ``quantiles``, is the row's length."""
    before = (F.col("docs_within") - F.col("n_docs")) / (F.col("docs_within") + F.col("docs_over"))
    asked = F.array(*[F.lit(float(s)) for s in shares])
    return limits.withColumn("shares", F.filter(asked, lambda s: (s > before) & (s <= F.col("quantile"))))


def limits_of(docs: DataFrame, vocabulary: str) -> DataFrame:
    return context_limits(stored(histogram(docs, vocabulary), "histogram"))
