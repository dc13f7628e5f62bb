"""Hard negatives by inner product, with coordinate pruning of length buckets.

A row's vector becomes integers (``floor(scale * x)``); scores are exact
integer inner products, higher first, ties by smaller id.  An anchor's
positives are its best other rows of the same label; for each of them the best
rows of other labels are wanted whose score lies in a band of the positive's.

Both searches run on a grid of (anchor group, shard of all rows).  Rows are
kept in buckets of similar length (LEMP; Teflioudi, Gemulla and Mykytiuk,
2015).  A bucket holds, for every coordinate, its unit vectors' values in
order.  An anchor q that still needs scores of at least t has, in a bucket of
lengths up to l, the threshold c = t / (|q| l) on the cosine:

* c > 1: nothing in the bucket, nor in any shorter one, can reach t;
* 0 < c <= 1: unit vectors v with u.v >= c (u: the anchor's) lie within an angle
  of u, which bounds every coordinate: v_f >= c u_f - r (no bound if u_f <= -c)
  and v_f <= c u_f + r (no bound if u_f >= c), r = sqrt((1 - u_f**2) (1 - c**2)).
  The anchor's ``FOCUS`` largest coordinates give value ranges, found in the
  sorted lists by bisection, and only rows inside all of them are candidates;
* otherwise every row of the bucket is one.

Candidates are verified by the exact inner product and go to the anchor's list
of the best, whose last score is the next threshold.  Lists of the shards are
merged per anchor.  The result is exact.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; nor do vectors whose integer form is
longer than 2**30 (scores would leave the range of long).  Vectors meet
vectors of their own size only.  Rows that repeat are rows of their own, but a
row with an anchor's id is no partner of it; a positive without rows in its
band gives no row; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import shuffle_partitions, stored

#: Rows of a bucket.
BUCKET = 2048
#: Rows a task sorts by length before it cuts buckets.
HELD = 16 * BUCKET
#: Anchors of one grid cell.
ANCHORS = 2048
#: Coordinates whose ranges are intersected.
FOCUS = 4
#: Longest integer vector.
LONGEST = float(1 << 30)
#: Rounding of unit vectors, far above its error.
_SLACK = 1e-9

_BUCKETS = "dim int, turn long, n int, longest double, ids binary, labels binary, vectors binary"
_FOUND = "anchor long, part int, other_id long, score long"


def _integers(vector: pa.Scalar, scale: int) -> np.ndarray | None:
    """``floor(scale * x)`` of a vector that takes part."""
    values = vector.values
    if not vector.is_valid or values.null_count:
        return None
    x = values.to_numpy(zero_copy_only=False).astype(np.float64)
    if not np.isfinite(x).all() or np.abs(x).max(initial=0) * scale > LONGEST:
        return None
    x = np.floor(scale * x)
    return x.astype(np.int64) if np.sqrt((x * x).sum()) <= LONGEST else None


def _read(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(position or handle, id, label, integers) of rows that take part."""
    for batch in batches:
        names = batch.schema.names
        handles = batch.column("anchor").to_pylist() if "anchor" in names else [0] * batch.num_rows
        for handle, i, label, vector in zip(handles, batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(),
                                            batch.column("embedding")):
            if i is not None and label is not None and vector.is_valid:
                x = _integers(vector, scale)
                if x is not None:
                    yield handle, i, label, x


def _buckets(scale: int):
    """Rows to buckets of similar length, longest first."""

    def cut(turn: int, rows: list) -> Iterator[pa.RecordBatch]:
        vectors = np.stack([r[2] for r in rows])
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        ids, labels = (np.array([r[k] for r in rows], np.int64)[order] for k in (0, 1))
        vectors, lengths = vectors[order], lengths[order]
        for at in range(0, len(rows), BUCKET):
            b = slice(at, at + BUCKET)
            row = (vectors.shape[1], turn, len(ids[b]), float(lengths[at]), ids[b].tobytes(), labels[b].tobytes(),
                   vectors[b].astype(np.int32).tobytes())
            types = (pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary())
            names = [c.split()[0] for c in _BUCKETS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)
            turn += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn, held = TaskContext.get().partitionId() << 32, {}
        for _, i, label, x in _read(batches, scale):
            rows = held.setdefault(len(x), [])
            rows.append((i, label, x))
            if len(rows) == HELD:
                yield from cut(turn, held.pop(len(x)))
                turn += HELD // BUCKET
        for rows in held.values():
            yield from cut(turn, rows)
            turn += -(-len(rows) // BUCKET)

    return run


class _Bucket:
    """Rows of similar length with a sorted list per coordinate."""

    def __init__(self, row: dict):
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(row["n"], row["dim"]).astype(np.float64)
        self.longest = row["longest"]
        lengths = np.sqrt((self.vectors ** 2).sum(axis=1))
        self.units = self.vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The bucket's rows in order of unit coordinate ``f``, and its values."""
        if f not in self.lists:
            order = np.argsort(self.units[:, f], kind="stable")
            self.lists[f] = order, self.units[order, f]
        return self.lists[f]

    def candidates(self, unit: np.ndarray, length: float, focus: list[int], least: float) -> np.ndarray:
        """Rows that may score ``least`` or more with the anchor."""
        everything = np.arange(len(self.ids))
        if least <= 0:
            return everything
        reach = length * self.longest
        c = least / reach * (1 - _SLACK) if reach else np.inf
        if c > 1:
            return everything[:0]
        inside = np.zeros(len(self.ids), np.int8)
        for f in focus:
            order, values = self.sorted_list(f)
            off = np.sqrt(max(0.0, (1 - unit[f] ** 2) * (1 - c * c))) + _SLACK
            least_f = -1.0 if unit[f] <= -c + _SLACK else c * unit[f] - off
            most_f = 1.0 if unit[f] >= c - _SLACK else c * unit[f] + off
            low, high = np.searchsorted(values, least_f - _SLACK), np.searchsorted(values, most_f + _SLACK, "right")
            inside[order[low:high]] += 1
        return np.flatnonzero(inside == len(focus))

    def scores(self, rows: np.ndarray, vector: np.ndarray, length: float) -> np.ndarray:
        if self.longest * length < 2.0 ** 52:  # sums of products stay exact in double
            return (self.vectors[rows] @ vector).astype(np.int64)
        return self.vectors[rows].astype(np.int64) @ vector.astype(np.int64)


class _Best:
    """The best (score, id) rows of one list."""

    def __init__(self, size: int, low: int | None = None, high: int | None = None):
        self.size, self.low, self.high = size, low, high
        self.ids, self.values = np.empty(0, np.int64), np.empty(0, np.int64)

    def least(self) -> float:
        """Scores below this cannot enter."""
        floor = -np.inf if self.low is None else self.low
        return max(floor, self.values[-1]) if len(self.values) == self.size else floor

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = scores >= self.least()
        if self.high is not None:
            fit &= scores <= self.high
        if not fit.any():
            return
        ids, scores = np.concatenate((self.ids, ids[fit])), np.concatenate((self.values, scores[fit]))
        if len(scores) > 8 * self.size:
            near = scores >= np.partition(scores, -self.size)[-self.size]
            ids, scores = ids[near], scores[near]
        order = np.lexsort((ids, -scores))[:self.size]
        self.ids, self.values = ids[order], scores[order]


class _Anchor:
    def __init__(self, row: dict, same: bool, size: int, low: int, high: int):
        self.handle, self.id, self.label, self.same = row["anchor"], row["vec_id"], row["label"], same
        self.vector = np.frombuffer(row["vector"], np.int64).astype(np.float64)
        self.length = float(np.sqrt((self.vector ** 2).sum()))
        self.unit = self.vector / (self.length or 1)
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:FOCUS].tolist()
        if same:
            self.lists = {0: _Best(size)}
        else:  # scores s with low * p <= 100 s <= high * p
            self.lists = {k: _Best(size, -(-low * p // 100), high * p // 100) for k, p in enumerate(row["scores"])
                          if -(-low * p // 100) <= high * p // 100}

    def meet(self, bucket: _Bucket) -> None:
        if not self.lists:
            return
        rows = bucket.candidates(self.unit, self.length, self.focus, min(b.least() for b in self.lists.values()))
        rows = rows[((bucket.labels[rows] == self.label) == self.same) & (bucket.ids[rows] != self.id)]
        if len(rows):
            scores, ids = bucket.scores(rows, self.vector, self.length), bucket.ids[rows]
            for best in self.lists.values():
                best.offer(ids, scores)


def _search(same: bool, size: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by cell, its anchors first."""
        cell, anchors = None, []

        def emit() -> Iterator[pa.RecordBatch]:
            out = [(a.handle, k, i, s) for a in anchors for k, best in a.lists.items()
                   for i, s in zip(best.ids.tolist(), best.values.tolist())]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                    [c.split()[0] for c in _FOUND.split(", ")])

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if (key := (row["dim"], row["grp"], row["shard"])) != cell:
                    yield from emit()
                    cell, anchors = key, []
                if row["kind"] == 0:
                    anchors.append(_Anchor(row, same, size, low, high))
                else:
                    bucket = _Bucket(row)
                    for anchor in anchors:
                        anchor.meet(bucket)
        yield from emit()

    return run


def _anchor_rows(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(h, i, label, len(x), x.tobytes()) for h, i, label, x in _read([batch], scale)]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)],
                                             ["anchor", "vec_id", "label", "dim", "vector"])

    return run


def _best_of(anchors: DataFrame, buckets: DataFrame, same: bool, size: int, low: int = 0, high: int = 0) -> DataFrame:
    """anchor, part, rank, other_id, score: the best rows of each anchor's lists over all buckets."""
    n = shuffle_partitions(anchors.sparkSession)
    groups = max(1, -(-anchors.count() // ANCHORS))
    every = lambda size: F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    turn = F.shiftright("turn", 32) + F.col("turn").bitwiseAND(0xFFFFFFFF)  # buckets are dealt in turn
    cells = anchors.select("*", F.lit(0).alias("kind"), F.lit(0.0).alias("longest"),
                           F.pmod(F.xxhash64("anchor"), F.lit(groups)).cast("int").alias("grp"), every(n).alias("shard"))
    rows = buckets.select("*", F.lit(1).alias("kind"), every(groups).alias("grp"), F.pmod(turn, F.lit(n)).cast("int").alias("shard"))
    key = ["dim", "grp", "shard"]
    cells = cells.unionByName(rows, allowMissingColumns=True).repartition(n, *key)
    cells = cells.sortWithinPartitions(*key, "kind", F.desc("longest"))
    found = cells.mapInArrow(_search(same, size, low, high), _FOUND)
    order = Window.partitionBy("anchor", "part").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score: for each of ``anchors`` and
    each of its best ``positives`` rows of ``vectors`` of its label, the best ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score`` (both: vec_id, embedding, label)."""
    columns = [F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
               F.col("embedding").cast("array<double>").alias("embedding")]
    buckets = stored(vectors.select(columns).mapInArrow(_buckets(scale), _BUCKETS), "buckets")
    asked = anchors.select(*columns, F.monotonically_increasing_id().alias("anchor")).mapInArrow(
        _anchor_rows(scale), "anchor long, vec_id long, label long, dim int, vector binary")
    asked = stored(asked, "anchors")
    best = stored(_best_of(asked, buckets, True, positives), "positives")
    lists = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "other_id", "score"))).alias("p"))
    asked = stored(asked.join(lists, "anchor").withColumn("scores", F.col("p.score")), "asked")
    found = _best_of(asked.drop("p"), buckets, False, negatives, low, high)
    own = asked.select("anchor", F.col("vec_id").alias("anchor_id"), F.posexplode("p").alias("part", "p"))
    return found.join(own, ["anchor", "part"]).select(
        "anchor_id", F.col("p.other_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
