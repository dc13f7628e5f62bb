"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldstat.session import checkpoint_root

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: what follows restarts from files that every executor
    sees, so a lost executor costs one task, not the steps before.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")  # the step's shuffle files go with its end
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started within hand at most so many rows at a time to Python: both the executor's buffers and its workers
    hold whole batches, and rows with texts or sets are large."""
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def released(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``step``, after which freed memory goes back to the system.  Workers outlive their tasks, and what their
    allocators keep counts beside the executor's heap in all later steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return run


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of ``frames`` has it (Spark compares names in any case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def attach(rows: DataFrame, table: DataFrame, keys: list[str], size: str, total: int,
           share: int = 1000) -> DataFrame:
    """``rows`` LEFT JOIN ``table`` (one row per key) without a hot task.

    ``table[size]`` is the number of ``rows`` that have the key.  Keys held by
    more than ``total / share`` rows number fewer than ``share``: their table
    rows are broadcast (the bound holds at every input size).  The other rows
    take a shuffled join, in which no key has more than ``total / share`` rows.
    """
    mark = free_name("heavy", rows, table)
    heavy = F.broadcast(table.filter(F.col(size) * share > total).withColumn(mark, F.lit(True)))
    light = table.filter(F.col(size) * share <= total)
    values = [c for c in table.columns if c not in keys]
    first = rows.join(heavy, keys, "left")
    hot = first.filter(F.col(mark)).drop(mark)
    cold = first.filter(F.col(mark).isNull()).drop(mark, *values)
    return hot.unionByName(cold.join(light, keys, "left"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "body",
           budget: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into slices of about ``budget`` bytes of ``column``, so
    that what a task holds does not depend on how long the texts are.  A number
    column gives the bytes itself."""
    for batch in batches:
        at, n, sizes = 0, batch.num_rows, batch.column(column)
        if n == 0:
            continue
        if pa.types.is_integer(sizes.type):
            lengths = sizes.to_pylist()
        else:
            lengths = [len(x) if x is not None else 0 for x in map(_buffer, sizes)]
        while at < n:
            stop, held = at, 0
            while stop < n and (stop == at or held + lengths[stop] <= budget):
                held += lengths[stop]
                stop += 1
            yield batch.slice(at, stop - at)
            at = stop


def _buffer(value: pa.Scalar):
    return value.as_buffer() if value.is_valid else None
