"""SimHash near-dedup with pigeonring filtering.

Fingerprint: 64 bits over the XXH64 (seed 42) of a text's word shingles.

Links (at most ``distance`` differing bits) are found on the distinct
fingerprints.  A fingerprint is a ring of ``distance + 1`` segments.  By the
pigeonring principle (Qin and Xiao, 2018) two fingerprints within the distance
have a start segment from which every chain of l consecutive segments differs
in at most floor(l * distance / segments) bits.  The budget of the first
segment is 0, so candidates share that segment: one row per fingerprint and
start is shuffled by it.  Within a task the second segment (at most one
differing bit) is looked up in sorted codes, and the following segments prune
the pairs that are left before the full Hamming check.

Neither candidates nor links are emitted as pairs: a task reduces the links of
a cell to a spanning forest, so it emits fewer rows than it reads.  A segment
value with more than ``CELL`` fingerprints is split into blocks, and every pair
of blocks becomes a cell of its own (exact, nothing is capped).  Components
come from ``components`` on the forest links.

Defined results: a text without words (null, empty, white space) has
fingerprint zero and links like any other; fewer words than a shingle make one
shingle; repeated rows are members of one component; a null doc_id never names
a component unless all members have none; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import attach, free_name, shuffle_partitions, slices, stored, text_bytes
from .components import components

#: Fingerprints of one segment value that are compared as one cell.
CELL = 4096
#: Candidate pairs held at once while a task checks its cells.
PAIRS = 1 << 21
_LANES = np.uint64(0x0001000100010001)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits."""
    counts = np.zeros(64, np.int64)
    starts = np.arange(0, len(hashes), 65535)
    for k in range(16):  # 4 lanes of 16 bits add up 65,535 hashes without a carry
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, starts)
        counts[k::16] = lanes.view(np.uint16).reshape(-1, 4).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(body: bytes, shingle: int = 4) -> int:
    """SimHash of a text; 0 for a text without words."""
    words = body.lower().split()  # bytes: A-Z only; splits at 0x20, 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n, digest = len(words) - size + 1, xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[size - 1:].tolist())),
                         np.uint64, n)
    return int(np.packbits(_bit_counts(hashes) * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = np.fromiter((fingerprint(b, shingle) for b in part.column("body").to_pylist()), np.uint64,
                                part.num_rows)
            columns = [c for c in part.schema.names if c != "body"]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in columns] + [pa.array(found.view(np.int64))], [*columns, "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, th (hash of the text as it is) and fp (64 bits as a long) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"),
                       text_bytes().alias("body"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, th long, fp long")


class _Forest:
    """Least member of each row's group, merged by arrays of pairs."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def merge(self, i: np.ndarray, j: np.ndarray) -> None:
        parent = self.parent
        while len(i):
            a, b = parent[i], parent[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent[:] = up


def _ring(bits: int, segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment, from the lowest bits up."""
    cuts = [bits * s // segments for s in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _pairs(codes: np.ndarray, width: int, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Index pairs into ascending ``codes`` that differ in at most ``reach`` (0 or 1) of the low ``width`` bits."""
    n = len(codes)
    for mask in [0] + [1 << b for b in range(width)] * (reach > 0):
        if mask:
            low = np.flatnonzero(codes & mask == 0)  # each pair from its end without the bit
            left = np.searchsorted(codes, codes[low] | mask, "left")
            right = np.searchsorted(codes, codes[low] | mask, "right")
        else:
            low = np.arange(n)
            left, right = low + 1, np.searchsorted(codes, codes, "right")
        counts = right - left
        low, left, counts = low[counts > 0], left[counts > 0], counts[counts > 0]
        sums = np.cumsum(counts)
        at = 0
        while at < len(low):
            stop = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + PAIRS, "right")))
            c = counts[at:stop]
            inner = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            yield np.repeat(low[at:stop], c), np.repeat(left[at:stop], c) + inner, mask
            at = stop


def _link_cells(fps: np.ndarray, cells: np.ndarray, start: int, distance: int, forest: _Forest,
                rows: np.ndarray) -> None:
    """Merge, in ``forest``, the rows of each cell (all of one start segment) that lie within the distance."""
    ring = _ring(64, distance + 1)
    chain = [ring[(start + s) % len(ring)] for s in range(len(ring))]
    budgets = [(length * distance) // len(ring) for length in range(1, len(ring) + 1)]
    if len(chain) == 1:
        chain, budgets = chain * 2, budgets * 2
    shift, width = chain[1]
    codes = (cells.astype(np.uint64) << np.uint64(width)) | ((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1))
    order = np.argsort(codes, kind="stable")
    codes, fps, rows = codes[order].astype(np.int64), fps[order], rows[order]
    for i, j, mask in _pairs(codes, width, budgets[1]):
        apart, spent = fps[i] ^ fps[j], np.full(len(i), int(mask > 0))
        for (shift, width), budget in zip(chain[2:], budgets[2:]):
            part = (apart >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            spent = spent + np.bitwise_count(part)
            keep = spent <= budget
            i, j, apart, spent = i[keep], j[keep], apart[keep], spent[keep]
        near = np.bitwise_count(apart) <= distance
        forest.merge(rows[i[near]], rows[j[near]])


def _link(distance: int):
    """Whole cells (rows sorted by cell) to forest links."""

    def links(table: pa.Table) -> Iterator[pa.RecordBatch]:
        start, seg, a, b, fp = (table.column(c).to_numpy() for c in ("start", "seg", "a", "b", "fp"))
        new = np.ones(len(fp), bool)
        new[1:] = (np.diff(start) != 0) | (np.diff(seg) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)
        cells, forest = np.cumsum(new), _Forest(len(fp))
        for s in np.unique(start):
            rows = np.flatnonzero(start == s)
            _link_cells(fp[rows].view(np.uint64), cells[rows], int(s), distance, forest, rows)
        joined = np.flatnonzero(forest.parent != np.arange(len(fp)))
        yield pa.RecordBatch.from_arrays([pa.array(fp[joined]), pa.array(fp[forest.parent[joined]])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= 64 * CELL:  # all but the last cell, which may go on, are whole
                table = pa.Table.from_batches(held)
                key = [table.column(c).to_numpy() for c in ("start", "seg", "a", "b")]
                same = np.logical_and.reduce([k == k[-1] for k in key])
                cut = n - int(np.argmin(same[::-1])) if not same.all() else 0
                if cut:
                    yield from links(table.slice(0, cut))
                held, n = table.slice(cut).to_batches(), n - cut
        if n:
            yield from links(pa.Table.from_batches(held))

    return run


def near_links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Forest links (u, v) between distinct fingerprints (column ``fp``) within ``distance`` bits."""
    ring = _ring(64, distance + 1)
    starts = [F.struct(F.lit(s).alias("start"),
                       F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)).alias("seg"))
              for s, (shift, width) in enumerate(ring)]
    rows = fps.select("fp", F.explode(F.array(*starts)).alias("k")).select("fp", "k.start", "k.seg")
    large = rows.groupBy("start", "seg").count().filter(F.col("count") > CELL)
    blocks = F.coalesce(F.ceil(F.col("count") / CELL), F.lit(1)).cast("int")
    rows = rows.join(large, ["start", "seg"], "left").withColumn("blocks", blocks)
    rows = rows.withColumn("own", F.pmod(F.xxhash64(F.lit("block"), "fp"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cells = rows.select("start", "seg", "fp", "own", other).select(
        "start", "seg", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp")
    n = shuffle_partitions(fps.sparkSession)
    cells = cells.repartition(n, "start", "seg", "a", "b").sortWithinPartitions("start", "seg", "a", "b")
    return cells.mapInArrow(_link(distance), "u long, v long")


def groups(prints: DataFrame, distance: int = 4) -> DataFrame:
    """fp, docs (rows that have it), component (its least fingerprint), component_id, members (rows of the
    component) for every distinct fp of ``prints`` (doc_id, fp)."""
    fps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("docs")), "fps")
    labels = components(near_links(fps.select("fp"), distance))
    labelled = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    labelled = stored(labelled, "labelled")
    named = labelled.groupBy("component").agg(
        F.min("first").alias("component_id"), F.sum("docs").alias("members"), F.count(F.lit(1)).alias("n_fps"))
    return attach(labelled.select("fp", "docs", "component"), stored(named, "named"), ["component"], "n_fps",
                  labelled.count()).drop("n_fps")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``docs``."""
    prints = stored(fingerprints(docs, shingle), "prints")
    grouped = stored(groups(prints, distance), "groups")
    rows = attach(prints.select("doc_id", "fp"), grouped, ["fp"], "docs", prints.count())
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
                       F.col("members").alias("component_size"))


def deduplicate(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id (then text hash).

    Rows that repeat doc_id and text are one document and share the decision.
    Only ids and hashes are grouped; texts meet the list of dropped documents
    in one join.
    """
    prints = stored(fingerprints(docs, shingle), "prints")
    grouped = stored(groups(prints, distance).filter("members > 1"), "groups")
    rows = attach(prints, grouped, ["fp"], "docs", prints.count()).filter("members > 1")
    rows = stored(rows.select("component", "members", "doc_id", "th"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("th"))
    first = rows.groupBy("component").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("size"))
    judged = attach(rows.select("component", "doc_id", "th"), stored(first, "first"), ["component"], "size", rows.count())
    dropped = judged.filter(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))))
    # the lists' names are put aside, whatever columns the documents have
    i, h = free_name("id", docs), free_name("th", docs)
    dropped = dropped.select(F.col("doc_id").alias(i), F.col("th").alias(h))
    here = F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(h))
    return docs.join(stored(dropped, "dropped"), here, "left_anti")
