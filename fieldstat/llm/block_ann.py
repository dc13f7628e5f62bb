"""Nearest neighbours of a stated query set by a block matrix join.

Vectors are packed into blocks.  The grid of (query group, candidate shard)
cells is dealt out by a shuffle; a cell holds one bounded group of queries and
streams its candidate blocks.  Each (queries, block) pair is one tile: both
sides are quantised to int8 with a scale per vector, and the tile's integer
products (exact in float32 matrix products for up to 1,040 components; longer
vectors are multiplied in parts) give approximate cosines.  With unit vectors
u = a + da and v = b + db, |u.v - a.b| <= |da| + |a| |db|: pairs whose
upper bound stays below the query's fifth-best lower bound cannot be among the
nearest and are dropped.  The others are recomputed from the original vectors
in double precision and go to the query's heap.  Heaps of the shards are merged
per query.  The result is exact, not approximate: recall is 1.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do null ids; components of any finite size count
(vectors beyond 1e140 or below 1e-140 are scaled by a power of two); vectors are compared with vectors of
their own length; rows that share an id are not candidates of each other; equal
scores rank by smaller id; repeated candidates with one id count once; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import shuffle_partitions, stored

#: Vectors in a block.
BLOCK = 2048
#: Blocks of queries that one grid cell holds.
QUERY_BLOCKS = 4
_BLOCKS = "dim int, block long, n int, ids binary, vectors binary"
_FOUND = "query_id long, vec_id long, score double"
#: Rounding of the float32 tile, far above its error for unit vectors.
_SLACK = 1e-5


def _blocks(kind: str):
    """Rows (vec_id, embedding) to blocks; ``kind``: the components as they are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, {}

        def emit(dim: int, ids: list, vectors: list) -> pa.RecordBatch:
            nonlocal number
            number += 1
            row = (dim, number, len(ids), np.array(ids, np.int64).tobytes(), np.stack(vectors).astype(kind).tobytes())
            types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)], [c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
                values = vector.values
                if vec_id is None or not vector.is_valid or values.null_count or not len(values):
                    continue
                v = values.to_numpy(zero_copy_only=False).astype(np.float64)
                largest = np.abs(v).max()
                if not np.isfinite(largest) or largest == 0:
                    continue
                if not 1e-140 < largest < 1e140:  # squares would leave the range of double
                    v = np.ldexp(v, -int(np.frexp(largest)[1]))
                ids, vectors = held.setdefault(len(v), ([], []))
                ids.append(vec_id)
                vectors.append(v)
                if len(ids) == BLOCK:
                    yield emit(len(v), *held.pop(len(v)))
        for dim, (ids, vectors) in held.items():
            yield emit(dim, ids, vectors)

    return run


class _Tile:
    """A block with its int8 form."""

    def __init__(self, row: dict, kind: str):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], kind).reshape(row["n"], row["dim"]).astype(np.float64)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        unit = self.vectors / self.norms[:, None]
        self.scales = np.abs(unit).max(axis=1) / 127
        self.codes = np.rint(unit / self.scales[:, None]).astype(np.int8)
        back = self.codes * self.scales[:, None]
        self.errors = np.sqrt(((unit - back) ** 2).sum(axis=1))
        self.lengths = np.sqrt((back * back).sum(axis=1))


def _approximate(q: _Tile, c: _Tile) -> tuple[np.ndarray, np.ndarray]:
    """Cosines from int8 products, and how far off each can be."""
    products = np.zeros((len(q.ids), len(c.ids)), np.float32)
    for at in range(0, q.codes.shape[1], 1024):  # integers below 2**24 stay exact in float32
        products += q.codes[:, at:at + 1024].astype(np.float32) @ c.codes[:, at:at + 1024].astype(np.float32).T
    near = products * np.outer(q.scales, c.scales).astype(np.float32)
    off = q.errors[:, None] + np.outer(q.lengths, c.errors) + _SLACK
    return near, off.astype(np.float32)


def _search(k: int, kind: str):
    def offer(heap: list, score: float, vec_id: int) -> None:
        """``heap``: the k best as (score, -id), worst first."""
        item = (score, -vec_id)
        if item in heap:
            return
        if len(heap) < k:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            heapq.heapreplace(heap, item)

    def tile(queries: _Tile, heaps: list[list], block: _Tile) -> None:
        near, off = _approximate(queries, block)
        lower, upper = near - off, near + off
        own = queries.ids[:, None] == block.ids[None, :]
        lower[own], upper[own] = -np.inf, -np.inf
        floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
        if lower.shape[1] >= k:
            distinct = len(np.unique(block.ids)) == len(block.ids)
            if distinct:
                floor = np.maximum(floor, np.partition(lower, -k, axis=1)[:, -k])
        rows, columns = np.nonzero((upper >= floor[:, None]) & ~own)
        for at in range(0, len(rows), 1 << 15):
            i, j = rows[at:at + (1 << 15)], columns[at:at + (1 << 15)]
            scores = (queries.vectors[i] * block.vectors[j]).sum(axis=1) / (queries.norms[i] * block.norms[j])
            for q, score, vec_id in zip(i.tolist(), scores.tolist(), block.ids[j].tolist()):
                heap = heaps[q]
                if len(heap) < k or (score, -vec_id) > heap[0]:
                    offer(heap, score, vec_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by cell, its queries first."""
        cell, queries, heaps = None, [], []

        def emit() -> Iterator[pa.RecordBatch]:
            for q, hs in zip(queries, heaps):
                out = [(vec_id, -item[1], item[0]) for vec_id, h in zip(q.ids.tolist(), hs) for item in h]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*out), (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                key = row["dim"], row["grp"], row["shard"]
                if key != cell:
                    yield from emit()
                    cell, queries, heaps = key, [], []
                block = _Tile(row, kind)
                if row["kind"] == 0:
                    queries.append(block)
                    heaps.append([[] for _ in range(row["n"])])
                else:
                    for q, hs in zip(queries, heaps):
                        tile(q, hs, block)
        yield from emit()

    return run


def _merge(k: int):
    """Heaps of the shards, rows sorted by query: the k best of each, ranked."""
    schema = ["query_id", "rank", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, held = None, []

        def best() -> list[tuple]:
            ranked = heapq.nsmallest(k, set(held))
            return [(query, r, vec_id, -score) for r, (score, vec_id) in enumerate(ranked, 1)]

        for batch in batches:
            out = []
            for q, v, s in zip(*(batch.column(c).to_pylist() for c in ("query_id", "vec_id", "score"))):
                if q != query:
                    out += best()
                    query, held = q, []
                held.append((-s, v))
            if out:
                yield _ranked(out, schema)
        if out := best():
            yield _ranked(out, schema)

    return run


def _ranked(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine) of the ``k`` nearest rows of ``vectors`` to each of ``queries``
    (both vec_id, embedding)."""
    spark = vectors.sparkSession
    n = shuffle_partitions(spark)
    single = vectors.schema["embedding"].dataType == queries.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    kind, array = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    columns = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(array).alias("embedding")]
    asked = stored(queries.select(columns).mapInArrow(_blocks(kind), _BLOCKS), "queries")
    groups = max(1, -(-asked.count() // QUERY_BLOCKS))
    turn = F.shiftright("block", 32) + F.col("block").bitwiseAND(0xFFFFFFFF)  # blocks are dealt in turn
    group, shard = (F.pmod(turn, F.lit(size)).cast("int") for size in (groups, n))
    every = lambda size: F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    cells = asked.select("*", F.lit(0).alias("kind"), group.alias("grp"), every(n).alias("shard")).unionByName(
        vectors.select(columns).mapInArrow(_blocks(kind), _BLOCKS).select(
            "*", F.lit(1).alias("kind"), every(groups).alias("grp"), shard.alias("shard")))
    key = ["dim", "grp", "shard"]
    found = cells.repartition(n, *key).sortWithinPartitions(*key, "kind", "block").mapInArrow(_search(k, kind), _FOUND)
    return found.repartition(n, "query_id").sortWithinPartitions("query_id").mapInArrow(
        _merge(k), "query_id long, rank int, vec_id long, score double")
