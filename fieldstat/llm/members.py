"""Rows whose 64-bit hash is among many keys, by a filter of bounded size that every task holds.

The keys' bits are set in one dense array (two bits per key, in one word of 64
bits).  Tasks send the words they set, the words are joined by a grouping, and
the array goes to every task.  It has 16 to 32 bits per key up to ``LARGEST``
bytes: beyond, it lets more rows pass, but never drops one that belongs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType

#: Bytes of the largest filter.
LARGEST = 32 << 20


def _places(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and bits of each hash."""
    h = hashes.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    one, six = np.uint64(1), np.uint64(63)
    bits = (one << (h & six)) | (one << ((h >> np.uint64(6)) & six))
    return ((h >> np.uint64(32)) % np.uint64(words)).astype(np.int64), bits


def _set_words(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, bits = _places(batch.column(0).to_numpy(zero_copy_only=False), words)
            order = np.argsort(at, kind="stable")
            at, bits = at[order], bits[order]
            if len(at):
                first = np.flatnonzero(np.diff(at, prepend=-1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[first]), pa.array(np.bitwise_or.reduceat(bits, first).view(np.int64))], ["at", "bits"])

    return run


def may_be_in(hashed: Column, keys: DataFrame) -> Column:
    """Whether ``hashed`` (long) may be among the only column (long, no nulls) of ``keys``; never false for one that is."""
    spark = keys.sparkSession
    words = min(LARGEST // 8, 1 << max(6, (keys.count() // 4).bit_length()))
    found = keys.mapInArrow(_set_words(words), "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    table = np.zeros(words, np.uint64)
    for batch in found.toArrow().to_batches():  # at most one row per word: bounded by LARGEST
        table[batch.column("at").to_numpy()] = batch.column("bits").to_numpy().view(np.uint64)
    held = spark.sparkContext.broadcast(table)

    def test(hashes: pa.Array) -> pa.Array:
        at, bits = _places(hashes.to_numpy(zero_copy_only=False), words)
        return pa.array((held.value[at] & bits) == bits)

    return F.arrow_udf(test, BooleanType())(hashed)
