"""Best-fit packing of documents into sequences by minimum bin slack.

A document is its ids and an end id.  One that is longer than a sequence is cut
into whole sequences; the first piece takes the rest.  Pieces as long as a
sequence are sequences by themselves.  The others are dealt into groups of
about ``GROUP`` pieces by a hash that no number of equal rows can load one group
with, and each group is packed by itself: a bin
starts with the longest piece left, and a bitset subset-sum over the lengths
available (Python's integers as bitsets) finds the fullest feasible
combination, which is then removed.  A group's last bins are its only loss, and
groups hold tens of thousands of pieces, so the number of sequences stays
within a small fraction of a percent of the lower bound.

Defined results: a null or empty text is the end id alone; equal rows are
packed each; a table without rows gives no pieces; extra columns are carried
by ``pack`` and ignored by ``pieces``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import free_name, slices, stored, text_bytes
from .tokens import encoder

#: Pieces packed together, on average.
GROUP = 40_000


def _pieces(path: str, capacity: int, end_id: int):
    names = ["doc_id", "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for part in slices(batches, budget=2 << 20):
            out = []
            for doc_id, body in zip(part.column("doc_id").to_pylist(), part.column("body").to_pylist()):
                ids = np.array(encode(body.decode("utf-8", "replace")) + [end_id], "<u4")
                ends = range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)
                start = 0
                for piece, end in enumerate(ends):
                    out.append((doc_id, piece, start, end - start, ids[start:end].tobytes()))
                    start = end
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return run


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian 32-bit integers) of every piece of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    return rows.mapInArrow(_pieces(path, capacity, end_id), "doc_id long, piece int, start long, length long, ids binary")


def fullest(counts: list[int], room: int) -> list[int]:
    """Lengths, at most ``counts[length]`` of each, with the largest sum up to ``room``."""
    reach, steps, limit = 1, [], (1 << (room + 1)) - 1
    for length in range(room, 0, -1):
        left, k = min(counts[length], room // length), 1
        while left and not reach >> room & 1:  # multiplicities by doubling: 1, 2, 4, ..., rest
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & limit
            left, k = left - k, 2 * k
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, []
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            chosen += [length] * k
            at -= length * k
    return chosen


def bins(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece (all at most ``capacity`` long)."""
    order = np.argsort(lengths, kind="stable")
    stacks = {int(v): s.tolist() for v, s in zip(*_runs(lengths[order], order))}
    counts = [len(stacks.get(v, ())) for v in range(capacity + 1)]
    bin_no, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    longest, n = capacity, 0
    while True:
        while longest > 0 and not counts[longest]:
            longest -= 1
        if not longest:
            return bin_no, offset
        counts[longest] -= 1
        at = 0
        rest = fullest(counts, capacity - longest) if longest < capacity else []
        for length in rest:
            counts[length] -= 1
        for length in [longest, *rest]:
            piece = stacks[length].pop()
            bin_no[piece], offset[piece] = n, at
            at += length
        n += 1


def _runs(ordered: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    values, first = np.unique(ordered, return_index=True)
    return values, np.split(order, first[1:])


def _pack(capacity: int, name: str):
    def run(table: pa.Table) -> pa.Table:
        group = table.column(name)[0].as_py()
        bin_no, offset = bins(table.column("length").to_numpy(), capacity)
        return table.drop_columns(name).append_column("sequence_id", pa.array(bin_no + (group << 32))).append_column(
            "offset", pa.array(offset))

    return run


def pack(rows: DataFrame, key: list[str], capacity: int = 1024) -> DataFrame:
    """``rows`` (with a ``length`` of 1 to ``capacity``) with sequence_id and offset; ``key`` and a row number deal
    them out, so rows that repeat the key spread as well."""
    rows = stored(rows, "pieces")
    groups = max(1, -(-rows.filter(F.col("length") < capacity).count() // GROUP))
    full = rows.filter(F.col("length") >= capacity).select(
        "*", (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    number = F.monotonically_increasing_id()  # of a stored row: the same when a task is run again
    name = free_name("group", rows)
    dealt = rows.withColumn(name, F.pmod(F.xxhash64(*key, number), F.lit(groups))).filter(F.col("length") < capacity)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    packed = dealt.groupBy(name).applyInArrow(_pack(capacity, name), f"{schema}, sequence_id long, offset long")
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs``."""
    cut = pieces(docs, path, capacity, end_id).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(cut, ["doc_id", "piece", "ids_crc32"], capacity)
