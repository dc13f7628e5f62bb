"""N-gram Jaccard join with rare-first prefix filtering.

A document's set holds its distinct word n-grams (``SHINGLE`` words, A-Z in
lower case), as 64-bit hashes.  Equal sets are one class.  Two classes link
when ``100 * |intersection| >= percent * |union|``.

1. Document frequencies.  A task cuts its documents into chunks of about
   ``ROUND`` n-grams and sends each chunk's distinct fingerprints (``log2`` of
   the corpus' n-grams plus ``SLACK_BITS`` bits), sorted and packed, to the
   owners of their ranges.  Owners add up and answer, per chunk, which of them
   occur elsewhere too and how often.  Nothing is sampled and no list of
   n-grams reaches the driver.
2. Prefix.  The global order is (frequency, fingerprint), rarest first.  Of a
   set of n only the first n - ceil(percent * n / 100) + 1 can be the first
   common n-gram of a link.  Those that occur nowhere else need no row, so most
   documents send none.
3. Candidates.  Rows meet by prefix n-gram.  Pairs pass the length filter, the
   positional filter (what can still follow the common n-gram) and the suffix
   filter: the n-grams behind the position are counted in ``BINS`` ranges of
   the hash, and the differences of the counts bound their overlap from above.
4. Verification.  Candidate pairs are made distinct and verified once, on the
   whole sets (before that, on counts of their n-grams by hash range, which
   bound the intersection).  Pairs are not listed group by group: a first pass
   takes only the pairs between the first class of a prefix n-gram (the one with
   the fewest rarer n-grams) and the others (a star); once their links are known, a second pass takes all other
   pairs whose classes are not yet connected.  So a group of k near copies costs
   about k pairs, and no link between components is lost.  A prefix n-gram of
   more than ``CELL`` classes is split into blocks, and each pair of blocks is
   compared by itself.

Defined results: fewer words than a shingle make one n-gram of the whole
sequence; a text without words (null, empty, white space) has an empty set and
is linked with nothing; rows that repeat id and text are rows of one class; a
null doc_id names no component unless all its rows have none; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType

from .common import attach, batches_of, released, shuffle_partitions, slices, stored, text_bytes
from .components import components
from .members import may_be_in
from .packed import pack, unpack

#: Words of an n-gram.
SHINGLE = 5
#: Fingerprint bits beyond log2(n-grams).
SLACK_BITS = 8
#: N-grams of a chunk.
ROUND = 1 << 19
#: Fingerprints for one owner, on average.
PER_OWNER = 2 << 20
#: Classes of one prefix n-gram that are compared as one cell.
CELL = 4096
#: A class with more than one in so many pairs is joined by a broadcast.
SHARE = 1000
#: Prefix rows of one lead that go to one task.
LEAD = 1 << 13
#: Prefix rows that a task compares at a time, and pairs that it holds meanwhile.
ROWS = 1 << 16
PAIRS = 1 << 19
#: Counts of sets that are compared at a time.
COUNTS = 1 << 22
#: Rows of texts or sets that are handed to Python at a time.
BATCH = 2000
#: Ranges of the suffix filter.
BINS = 32

_U64 = np.uint64
#: Odd multipliers of an n-gram's words.
_WEIGHTS = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(64)], _U64)
_SETS = "kind int, doc_id long, th long, n int, key binary, chunk long, owner long, code binary, counts binary"
_ROWS = "fp long, key binary, n int, pos int, after binary"


def gram_hashes(body: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams."""
    words = body.lower().split()  # bytes: A-Z only; splits at 0x20, 0x09-0x0D
    if not words:
        return np.empty(0, _U64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), _U64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    grams = np.full(n, size, _U64)
    for i in range(size):
        grams += h[i:i + n] * _WEIGHTS[i]
    grams ^= grams >> _U64(32)
    grams *= _U64(0xD6E8FEB86659FD93)
    grams ^= grams >> _U64(29)
    return np.unique(grams)


def _key(grams: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(grams.tobytes())


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))


def _read_sets(size: int, bits: int, owners: int):
    """Texts to rows of kind 0 (a document), 1 (a chunk's sets) and 2 (a chunk's message to an owner)."""
    span = -(-(1 << bits) // owners)

    def flush(chunk: int, sets: list) -> list[tuple]:
        fps = np.concatenate([s for _, s in sets]) >> _U64(64 - bits)
        distinct, ranks, counts = np.unique(fps, return_inverse=True, return_counts=True)
        cuts = np.searchsorted(distinct, np.arange(1, owners, dtype=_U64) * _U64(span))
        edges = [0, *cuts.tolist(), len(distinct)]
        rows = [(2, None, None, None, None, chunk, o, pack(distinct[a:b]), pack(counts[a:b]))
                for o, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
        sizes = np.array([len(s) for _, s in sets], _U64)
        rows.append((1, None, None, len(distinct), b"".join(k for k, _ in sets), chunk, None, pack(ranks),
                     pack(np.concatenate((np.array(edges[:-1], _U64), sizes)))))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, sets, seen, held = TaskContext.get().partitionId() << 32, [], set(), 0
        for part in slices(batches):
            out = []
            for doc_id, th, body in zip(*(part.column(c).to_pylist() for c in ("doc_id", "th", "body"))):
                grams = gram_hashes(body, size)
                key = _key(grams)
                out.append((0, doc_id, th, len(grams), key, None, None, None, None))
                if len(grams) and key not in seen:
                    seen.add(key)
                    sets.append((key, grams))
                    held += len(grams)
                if held >= ROUND:
                    out += flush(chunk, sets)
                    chunk, sets, seen, held = chunk + 1, [], set(), 0
            yield _batch(_SETS, out)
        if sets:
            yield _batch(_SETS, flush(chunk, sets))

    return run


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Whole runs of equal values of ``column``; only the run at hand is held."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        if held and held[-1].column(column)[0].as_py() != values[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts, cuts[1:]):
            held.append(batch.slice(a, b - a))
            if b < len(values):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages by owner to answers: places in the message, fingerprints and frequencies of what occurs elsewhere."""
    for group in _groups(batches, "owner"):
        chunks, owners = group.column("chunk").to_pylist(), group.column("owner").to_pylist()
        values = [unpack(c) for c in group.column("code").to_pylist()]
        counts = [unpack(c) for c in group.column("counts").to_pylist()]
        every = np.concatenate(values)
        order = np.argsort(every, kind="stable")
        first = np.flatnonzero(np.diff(every[order], prepend=every[order[0]] + _U64(1)))
        sums = np.add.reduceat(np.concatenate(counts)[order], first)
        shared, often = every[order][first][sums > 1], sums[sums > 1]
        out = []
        for chunk, owner, fps in zip(chunks, owners, values):
            at = np.searchsorted(shared, fps)
            hit = shared[np.minimum(at, len(shared) - 1)] == fps if len(shared) else np.zeros(len(fps), bool)
            if hit.any():
                out.append((0, None, None, None, None, chunk, owner,
                            pack(np.concatenate((np.flatnonzero(hit).astype(_U64), fps[hit]))), pack(often[at[hit]])))
        if out:
            yield _batch(_SETS, out)


def _histograms(fps: np.ndarray, bits: int, places: np.ndarray) -> np.ndarray:
    """Counts by hash range of what follows each place; 255 stands for that many or more."""
    bins = (fps >> _U64(bits - 5)).astype(np.int64)
    order = np.argsort(bins, kind="stable")
    after = np.empty((len(places), BINS), np.uint8)
    for b, spots in enumerate(np.split(order, np.searchsorted(bins[order], np.arange(1, BINS)))):
        after[:, b] = np.minimum(len(spots) - np.searchsorted(spots, places, "right"), 255)
    return after


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n + (-percent * n) // 100 + 1


def _prefixes(bits: int, percent: int):
    """A chunk's answers (kind 0), then its sets (kind 1), to prefix rows."""

    def rows(table: pa.Table, answers: list) -> Iterator[tuple]:
        distinct = table.column("n")[0].as_py()
        keys, more = table.column("key")[0].as_py(), unpack(table.column("counts")[0].as_py()).astype(np.int64)
        ranks = unpack(table.column("code")[0].as_py()).astype(np.int64)
        n_docs = len(keys) // 16
        offsets, sizes = more[:-n_docs], more[-n_docs:]
        often, known = np.ones(distinct, np.int64), np.zeros(distinct, _U64)
        for owner, code, counts in answers:
            both, found = unpack(code), unpack(counts)
            at = offsets[owner] + both[:len(found)].astype(np.int64)
            often[at], known[at] = found, both[len(found):]
        starts = np.cumsum(sizes) - sizes
        shared = often[ranks] > 1
        reach = prefix_length(sizes, percent)
        alone = sizes - np.add.reduceat(shared, starts, dtype=np.int64)
        for d in np.flatnonzero(alone < reach).tolist():
            own = ranks[starts[d]:starts[d] + sizes[d]]
            order = own[np.lexsort((own, often[own]))]
            places = np.flatnonzero(often[order[:reach[d]]] > 1)
            # the suffix is counted over what occurs elsewhere: only that can be common
            spots = np.flatnonzero(often[order] > 1)
            after = _histograms(known[order[spots]], bits, np.searchsorted(spots, places))
            key, n = keys[16 * d:16 * d + 16], int(sizes[d])
            fps, first = np.unique(known[order[places]].astype(np.int64), return_index=True)  # the first place counts
            for fp, at in zip(fps.tolist(), first.tolist()):
                yield fp, key, n, int(places[at]), after[at].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, answers = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                number, kind = row.column("chunk")[0].as_py(), row.column("kind")[0].as_py()
                if number != chunk:
                    chunk, answers = number, []
                if kind == 0:
                    answers.append(tuple(row.column(c)[0].as_py() for c in ("owner", "code", "counts")))
                else:
                    for some in batched(rows(pa.Table.from_batches([row]), answers), 1 << 16):
                        yield _batch(_ROWS, some)

    return run


def _needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least intersection of linked sets of n and m: 100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def _passing(cell: dict, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs pass the length, positional and suffix filters."""
    n, pos, after = cell["n"], cell["pos"], cell["after"]
    least = _needed(n[i], n[j], percent)
    before = np.minimum(pos[i], pos[j])
    ahead_i, ahead_j = n[i] - pos[i] - 1, n[j] - pos[j] - 1
    ok = (np.minimum(n[i], n[j]) >= least) & (before + 1 + np.minimum(ahead_i, ahead_j) >= least)
    at = np.flatnonzero(ok)
    for a in range(0, len(at), 1 << 16):
        part = at[a:a + (1 << 16)]
        common = np.minimum(after[i[part]], after[j[part]]).sum(axis=1, dtype=np.int64)
        # a range cut at 255 counts as unbounded
        full = ((after[i[part]] == 255) & (after[j[part]] == 255)).any(axis=1)
        ok[part] = full | (before[part] + 1 + common >= least[part])
    return ok


def _star_pairs(cell: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """In each cell, the first class of every component with the first of all (rows are in order of cell and place)."""
    _, heads = np.unique(cell * (group.max() + 1) + group, return_index=True)
    heads = np.sort(heads)
    first = np.searchsorted(cell, cell[heads])
    apart = first != heads
    yield first[apart], heads[apart]


def _all_pairs(cell: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """In each cell, every two classes of different components."""
    after = np.searchsorted(cell, cell, "right") - np.arange(len(cell)) - 1  # rows of the cell that follow
    sums, at = np.cumsum(after), 0
    while at < len(cell):
        stop = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + PAIRS, "right")))
        n = after[at:stop]
        i = np.repeat(np.arange(at, stop), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        apart = group[i] != group[j]
        yield i[apart], j[apart]
        at = stop


def _candidates(percent: int, star: bool):
    """Cells (rows sorted by lead and cell) to candidate pairs (u, v) of classes that are not yet connected."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        keys = table.column("key").combine_chunks().dictionary_encode()
        key, names = keys.indices.to_numpy().astype(np.int64), keys.dictionary
        group = key  # in the first pass no classes are connected yet
        if not star:
            group = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        cell = np.cumsum(_breaks(table))
        rows = {"n": table.column("n").to_numpy().astype(np.int64), "pos": table.column("pos").to_numpy().astype(np.int64),
                "after": np.frombuffer(b"".join(table.column("after").to_pylist()), np.uint8).reshape(-1, BINS)}
        bins = None if star else table.column("bins").to_pylist()
        found = []
        for i, j in (_star_pairs if star else _all_pairs)(cell, group):
            ok = np.flatnonzero(_passing(rows, i, j, percent))
            if bins is not None:
                ok = ok[_room(bins, i[ok], j[ok], percent)]
            found.append(np.unique(key[i[ok]] * len(names) + key[j[ok]]))  # a pair meets in many cells of one lead
        u, v = np.divmod(np.unique(np.concatenate(found)), len(names))
        return pa.RecordBatch.from_arrays([names.take(pa.array(u)), names.take(pa.array(v))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= ROWS:  # all but the last cell, which may go on, are whole
                table = pa.Table.from_batches(held)
                cut = int(np.flatnonzero(_breaks(table))[-1])
                if cut:
                    yield pairs(table.slice(0, cut))
                    held, n = table.slice(cut).to_batches(), n - cut
        if n:
            yield pairs(pa.Table.from_batches(held))

    return run


def _breaks(table: pa.Table) -> np.ndarray:
    """Where a cell begins."""
    new = np.ones(table.num_rows, bool)
    new[1:] = (np.diff(table.column("spread").to_numpy()) != 0) | (np.diff(table.column("cell").to_numpy()) != 0)
    return new


def _several(rows: DataFrame, column: Column) -> DataFrame:
    """fp that rows with different values of ``column`` have (two hashes of the value, as numbers, keep this a hash aggregate)."""
    hashes = [(F.xxhash64(column), "a"), (F.hash(column), "b")]
    ends = [f(h).alias(f"{name}{end}") for h, name in hashes for f, end in ((F.min, 0), (F.max, 1))]
    return rows.groupBy("fp").agg(*ends).filter("a0 <> a1 OR b0 <> b1").select("fp")


def _unsettled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the prefix n-grams whose classes are not all connected yet (and now and then of others), with their
    components.  Which n-grams these are is told from two columns: no other row is shuffled whole."""
    component = F.coalesce("component", "key")
    named = attach(rows.select("fp", "key"), labels, ["key"], "size", rows.count())
    wanted = stored(_several(named, component), "unsettled")
    rows = stored(rows.filter(may_be_in(F.col("fp"), wanted)), "unsettled-rows")
    return attach(rows, labels, ["key"], "size", rows.count()).drop("size").withColumn("component", component)


def _cells(rows: DataFrame, labels: DataFrame | None, sets: DataFrame | None) -> DataFrame:
    """Prefix rows by cell: a prefix n-gram, or a pair of blocks of one that many classes have.

    A cell's first class (lead) is the one with the fewest rarer n-grams: the
    text that near copies were made from has none of their own changes.  Cells
    with the same lead go to the same task, because classes that meet once
    mostly meet in many n-grams; a lead of more than ``LEAD`` rows is spread
    over several tasks.  With ``sets``, rows carry their set's counts.
    """
    if labels is not None:
        rows = _unsettled(rows, labels)
    first = F.min(F.struct("pos", F.hash("key").alias("lead")))
    grams = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("count"), first["lead"].alias("lead"))
    leads = grams.groupBy("lead").agg(F.sum("count").alias("rows"))
    grams = grams.join(leads, "lead").select("fp", "count", "lead", F.ceil(F.col("rows") / LEAD).alias("parts"))
    rows = attach(rows, grams.withColumnRenamed("count", "size"), ["fp"], "size", rows.count()).filter("size IS NOT NULL")
    if sets is not None:
        rows = stored(rows.withColumnRenamed("size", "often"), "open")
        uses = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        rows = attach(rows, stored(sets.select("key", "bins").join(uses, "key"), "bins"), ["key"], "size", rows.count())
        rows = rows.drop("size").withColumnRenamed("often", "size")
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / CELL).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.xxhash64("fp", F.least("own", "other"), F.greatest("own", "other"))
    spread = F.xxhash64("lead", F.pmod(cell, F.col("parts")))
    n = shuffle_partitions(rows.sparkSession)
    columns = ["key", "n", "pos", "after"] + ["component"] * (labels is not None) + ["bins"] * (sets is not None)
    rows = rows.select(spread.alias("spread"), cell.alias("cell"), *columns)
    return rows.repartition(n, "spread").sortWithinPartitions("spread", "cell", "pos", "key")


def _linked(percent: int) -> Column:
    """Whether the packed sets ``su`` and ``sv`` link: the one full check of a pair."""

    def check(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left, right):
            x, y = np.frombuffer(a.as_buffer(), _U64), np.frombuffer(b.as_buffer(), _U64)
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.array(out, pa.bool_())

    return F.arrow_udf(check, BooleanType())("su", "sv")


def _bins(grams: np.ndarray) -> bytes:
    """Counts by hash range, about two n-grams a range; 255 stands for that many or more."""
    width = min(12, max(5, (len(grams) // 2).bit_length()))
    return np.minimum(np.bincount((grams >> _U64(64 - width)).astype(np.int64), minlength=1 << width), 255).astype(np.uint8).tobytes()


def _room(bins: list[bytes], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets, by their counts, may link: the suffix filter from place 0, with narrower ranges."""
    widths = np.array([len(b) for b in bins])
    common, ok = np.minimum(widths[i], widths[j]), np.ones(len(i), bool)
    for width in np.unique(common).tolist():
        at = np.flatnonzero(common == width)
        used, where = np.unique(np.concatenate((i[at], j[at])), return_inverse=True)
        folded = np.empty((len(used), width), np.uint16)
        capped = np.empty(len(used), bool)
        for row, k in enumerate(used.tolist()):
            counts = np.frombuffer(bins[k], np.uint8)
            folded[row], capped[row] = counts.reshape(width, -1).sum(axis=1), counts.max() == 255
        sizes, step = folded.sum(axis=1, dtype=np.int64), max(1, COUNTS // width)
        for a in range(0, len(at), step):
            x, y = where[:len(at)][a:a + step], where[len(at):][a:a + step]
            shared = np.minimum(folded[x], folded[y]).sum(axis=1, dtype=np.int64)
            ok[at[a:a + step]] = capped[x] | capped[y] | (shared >= _needed(sizes[x], sizes[y], percent))
    return ok


def _may_link(percent: int) -> Column:
    """Whether the counts ``su`` and ``sv`` leave room for a link."""

    def check(left: pa.Array, right: pa.Array) -> pa.Array:
        n = len(left)
        return pa.array(_room(left.to_pylist() + right.to_pylist(), np.arange(n), np.arange(n, 2 * n), percent))

    return F.arrow_udf(check, BooleanType())("su", "sv")


def _with_ends(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """``pairs`` with that column of both classes, as su and sv.  Classes with more than one in ``SHARE`` of all pairs,
    which number fewer than ``SHARE``, are broadcast."""
    total, found = pairs.count(), pairs
    for end, name in (("u", "su"), ("v", "sv")):
        often = pairs.groupBy(end).agg(F.count(F.lit(1)).alias("size"))
        hot = F.broadcast(often.filter(F.col("size") * SHARE > total).select(end))
        table = sets.select(F.col("key").alias(end), F.col(column).alias(name))
        few = F.broadcast(table.join(hot, end, "left_semi"))
        found = found.join(few, end).unionByName(found.join(hot, end, "left_anti").join(table, end))
    return found


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, counted: bool) -> DataFrame:
    """Links (u, v) among distinct candidate pairs.  Whole sets travel only for pairs that their counts leave
    (``counted``: the counts have been compared)."""
    if not counted:
        pairs = stored(_with_ends(pairs, sets, "bins").filter(_may_link(percent)).select("u", "v"), "left")
    return _with_ends(pairs, sets, "set").filter(_linked(percent)).select("u", "v")


def _set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [gram_hashes(b, size) for b in part.column("body").to_pylist()]
            right = [_key(s) == k for s, k in zip(sets, part.column("key").to_pylist())]
            yield _batch("key binary, set binary, bins binary", [(_key(s), s.tobytes(), _bins(s)) for s, r in zip(sets, right) if r])

    return run


def _sets_of(docs: DataFrame, rows: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """key, set (sorted hashes), bins (counts by hash range) of each class with a prefix row, from one document of each class."""
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "th")
    chosen = classes.groupBy("key").agg(F.min(place).alias("p")).join(rows.select("key").distinct(), "key", "left_semi")
    chosen = stored(chosen.select("key", "p.*"), "chosen")
    texts = docs.select(F.col("doc_id").isNotNull().alias("known"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                        F.xxhash64("text").alias("th"), text_bytes().alias("body"))
    texts = texts.filter(may_be_in(F.col("th"), chosen.select("th"))).join(chosen, ["known", "doc_id", "th"])
    # rows that repeat id and text: one of them, found where the join has put them
    texts = texts.groupBy("known", "doc_id", "th").agg(F.first("key").alias("key"), F.first("body").alias("body"))
    return stored(texts.mapInArrow(released(_set_rows(size)), "key binary, set binary, bins binary"), "sets")


def similar(docs: DataFrame, size: int = SHINGLE, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles (set size), component_id (smallest doc_id reachable by links, its own included) and
    component_size (rows) of every row of ``docs`` (doc_id, text)."""
    with batches_of(docs.sparkSession, BATCH):  # all steps in Python run before this returns
        return _similar(docs, size, percent)


def _similar(docs: DataFrame, size: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), text_bytes().alias("body"))
    volume = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    bits = min(62, max(1, volume // 12).bit_length() + SLACK_BITS)
    owners = max(parts, -(-(volume // 6) // PER_OWNER))
    read = stored(rows.mapInArrow(released(_read_sets(size, bits, owners)), _SETS), "sets-read")
    classes = read.filter("kind = 0").select("doc_id", "th", "n", "key")

    messages = read.filter("kind = 2").select("chunk", "owner", "code", "counts")
    answers = messages.repartition(owners, "owner").sortWithinPartitions("owner").mapInArrow(released(_answer), _SETS)
    answers = stored(answers, "answers")
    both = answers.unionByName(read.filter("kind = 1")).select("chunk", "kind", "owner", "n", "key", "code", "counts")
    both = both.repartition(max(parts, owners), "chunk").sortWithinPartitions("chunk", "kind")
    prefixes = stored(both.mapInArrow(released(_prefixes(bits, percent)), _ROWS), "prefixes")
    several = stored(_several(prefixes, F.col("key")), "several")  # n-grams that two classes have
    prefixes = prefixes.filter(may_be_in(F.col("fp"), several)).join(several, "fp", "left_semi")
    prefixes = stored(prefixes.distinct(), "shared")  # a class may lie in several chunks
    sets = _sets_of(docs, prefixes, classes, size)

    uses = prefixes.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    links, labels, tried = None, None, None
    for star in (True, False):
        cells = _cells(prefixes, labels, None if star else sets)
        pairs = cells.mapInArrow(released(_candidates(percent, star)), "u binary, v binary").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["u", "v"], "left_anti")  # a pair is verified once
        tried = stored(pairs, "pairs")
        found = _verified(tried, sets, percent, counted=not star)
        links = stored(found if links is None else found.unionByName(links), "verified")
        labels = components(links).select(F.col("node").alias("key"), "component")
        labels = stored(labels.join(uses, "key"), "labels")

    named = classes.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("docs"))
    named = named.join(labels.select("key", "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    named = stored(named, "named")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"), F.sum("docs").alias("members"),
                                           F.count(F.lit(1)).alias("parts"))
    named = attach(named, stored(least, "least"), ["component"], "parts", named.count())
    some = classes.filter("n > 0")
    table = stored(named.select("key", "component_id", "members", "docs"), "classes")
    out = attach(some, table, ["key"], "docs", some.count()).select("doc_id", "n", "component_id", "members")
    out = out.unionByName(classes.filter("n = 0").select(
        "doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("members")))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id",
                      F.col("members").alias("component_size"))
