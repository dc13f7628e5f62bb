"""Substring dedup by suffix automata of reference shards.

A window is ``window`` consecutive words of one document.  A word goes if a
window covering it also starts in a document with a smaller doc_id.

The corpus is its own reference, so shards are cut by content: every window
belongs to its anchor, the least hash among its ``anchor``-word sequences.
Equal windows have equal anchors and meet in one shard, whatever stands around
them.  Consecutive windows of a document with the same anchor form a *run*,
and only runs move:

1. Tasks send the anchors of their documents to owners, once per round (about
   ``ROUND`` bytes of texts) where a round has an anchor repeatedly.  Owners
   answer, per message, with the places of anchors that occur more than once:
   only there can a window repeat.  A round's answers meet again, so a document
   has one row however many owners there are.
2. Those runs are cut from their texts.  Equal runs are merged before the
   shuffle; the smallest doc_id of each distinct run is kept.
3. Each shard (all distinct runs of its anchors, by ascending doc_id) streams
   its runs through its suffix automaton: matching statistics find each window
   seen before; the spans not seen before are then added.  An automaton is
   bounded: it starts anew between anchors after ``SHARD`` words.  The few
   anchors with more than ``RUNS`` distinct runs (edges of very common
   passages) would outgrow a shard; their windows are compared one by one by
   a grouping instead.
4. Each occurrence of a run is covered as a whole if a smaller document has
   the run, else at the windows found in step 3.  Covered spans meet their
   text once more, and the words outside are kept.

The shards' automata are built where their runs land.  They are not broadcast:
the reference is the corpus, so its automata would grow with it and every
document would have to pass all of them.

Defined results: null and empty texts have no words and keep none (digest of
the empty string); a null doc_id counts as larger than any other; windows of
rows that share a doc_id do not remove each other; repeated rows get equal
results; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import attach, shuffle_partitions, slices, stored, text_bytes

#: Words of an anchor.
ANCHOR = 5
#: Words after which a shard's automaton starts anew (between anchors).
SHARD = 1 << 16
#: Distinct runs of one anchor that stay in one shard.
RUNS = 2000
#: Anchors (8 bytes each) beyond ``RUNS`` that may be broadcast; more are joined by a shuffle.
BROADCAST_ANCHORS = 1_000_000
#: Bytes of text whose anchors one owner holds, on average; more text has more owners.
PER_OWNER = 128 << 20
#: Bytes of text whose anchors are sent as one message round.
ROUND = 8 << 20
_LAST = (1 << 63) - 1
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
_UNMIX = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_COLUMNS = ("anchor", "doc", "run", "start", "length")
_KINDS = {"anchor": np.uint64, "doc": np.uint32, "run": np.uint64, "start": np.uint32, "length": np.uint32}
_MESSAGE = [("owner", pa.int64()), ("round", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("docs", pa.binary()),
            *[(c, pa.binary()) for c in _COLUMNS]]
_MESSAGES = "owner long, round long, kind int, n int, docs binary, " + ", ".join(f"{c} binary" for c in _COLUMNS)
_PLACES = "key long, doc_id long, anchors array<long>, runs array<long>, starts array<int>, lengths array<int>"


def _planes(values: np.ndarray) -> bytes:
    """Bytes of integers, lowest of all first: zero bytes of small values lie together and compress away."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unplanes(data: bytes, n: int, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


def _runs(words: list[bytes], window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Anchor value, hash of its words, first window and number of windows of each run of a document with at
    least ``window`` words."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - anchor + 1
    grams = np.zeros(n, np.uint64)
    for k in range(anchor):
        grams = grams * _MIX[0] + hashes[k:k + n]
    grams = _mixed(grams)
    span = window - anchor + 1
    m = n - span + 1
    least, place = grams[:m].copy(), np.arange(m)
    for k in range(1, span):
        less = grams[k:k + m] < least
        least[less] = grams[k:k + m][less]
        place[less] = np.flatnonzero(less) + k
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    length = np.diff(np.append(first, m))
    # sums of hash * mix**place; the quotient by mix**first does not depend on where the run stands
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * np.cumprod(np.full(len(words), _MIX[0])), dtype=np.uint64)))
    back = np.cumprod(np.full(len(words), _UNMIX))
    run = _mixed((sums[first + length + window - 1] - sums[first]) * back[first])
    return least[first], run, first.astype(np.uint32), length.astype(np.uint32)


def _message(owner: int, round_no: int, kind: int, docs: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """``docs``: key and doc_id of the documents that column doc counts."""
    row = [owner, round_no, kind, len(columns["anchor"]), docs.tobytes(), *[_planes(columns[c]) for c in _COLUMNS]]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(row, _MESSAGE)], [c for c, _ in _MESSAGE])


def _of_some(docs: np.ndarray, columns: dict[str, np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Documents and columns of some places."""
    used, doc_here = np.unique(columns["doc"][rows], return_inverse=True)
    return docs[used], {c: v[rows] for c, v in columns.items()} | {"doc": doc_here.astype(np.uint32)}


def _send(owners: int, window: int, anchor: int):
    def flush(keys: list[tuple[int, int]], parts: list, round_no: int) -> Iterator[pa.RecordBatch]:
        docs = np.array(keys, np.int64)
        table = dict(zip(("anchor", "run", "start", "length"), (np.concatenate(x) for x in zip(*parts))))
        table["doc"] = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p[0]) for p in parts])
        order = np.argsort(table["anchor"], kind="stable")
        table = {c: v[order] for c, v in table.items()}
        value = table["anchor"]
        first = np.concatenate(([True], value[1:] != value[:-1]))
        last = np.concatenate((first[1:], [True]))
        alone = first & last
        if not alone.all():  # here twice already: these places need no answer, the owner only needs the anchor
            yield _message(0, round_no, 0, docs, {c: v[~alone] for c, v in table.items()})
        step = min((1 << 64) // owners + 1, (1 << 64) - 1)
        for kind, rows in ((1, alone), (2, first & ~alone)):
            at = np.flatnonzero(rows)
            cuts = np.searchsorted(value[at], np.arange(1, owners, dtype=np.uint64) * np.uint64(step))
            for owner, part in enumerate(np.split(at, cuts)):
                if len(part) and kind == 1:
                    yield _message(owner, round_no, 1, *_of_some(docs, table, part))
                elif len(part):
                    yield _message(owner, round_no, 2, docs[:0], {c: value[part] if c == "anchor" else v[:0] for c, v in table.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        round_no, keys, parts, held = TaskContext.get().partitionId() << 32, [], [], 0
        for part in slices(batches):
            for key, doc_id, body in zip(*(part.column(c).to_pylist() for c in ("key", "doc_id", "body"))):
                words = body.split()
                if len(words) >= window:
                    parts.append(_runs(words, window, anchor))
                    keys.append((key, doc_id))
                    held += len(body)
            if held >= ROUND:
                yield from flush(keys, parts, round_no)
                round_no, keys, parts, held = round_no + 1, [], [], 0
        if parts:
            yield from flush(keys, parts, round_no)

    return run


def _docs_of(m: dict) -> np.ndarray:
    return np.frombuffer(m["docs"], np.int64).reshape(-1, 2)


def _columns_of(m: dict) -> dict[str, np.ndarray]:
    return {c: _unplanes(m[c], m["n"], _KINDS[c]) for c in _COLUMNS}


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owners: rows come sorted by kind and owner; kind 0 passes, of kind 1 the places of repeated anchors."""

    def owner_hits(messages: list[dict]) -> Iterator[pa.RecordBatch]:
        found = [_unplanes(m["anchor"], m["n"], np.uint64) for m in messages]
        distinct, counts = np.unique(np.concatenate(found), return_counts=True)
        bare = np.concatenate([f for f, m in zip(found, messages) if m["kind"] == 2] or [distinct[:0]])
        repeated = np.union1d(distinct[counts > 1], bare)
        for value, m in zip(found, messages):
            if m["kind"] == 1 and len(repeated):
                at = np.minimum(np.searchsorted(repeated, value), len(repeated) - 1)
                hit = repeated[at] == value
                if hit.any():
                    yield _message(m["owner"], m["round"], 0, *_of_some(_docs_of(m), _columns_of(m), np.flatnonzero(hit)))

    held: list[dict] = []
    for batch in batches:
        for m in batch.to_pylist():
            if m["kind"] == 0:
                yield _message(m["owner"], m["round"], 0, _docs_of(m), _columns_of(m))
                continue
            if held and held[0]["owner"] != m["owner"]:
                yield from owner_hits(held)
                held = []
            held.append(m)
    if held:
        yield from owner_hits(held)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers, sorted by round, to one row per document of a round: its places as arrays, by their start."""

    def documents(messages: list[dict]) -> pa.RecordBatch:
        tables = [_columns_of(m) for m in messages]
        owner = np.concatenate([_docs_of(m)[t["doc"]] for m, t in zip(messages, tables)])
        table = {c: np.concatenate([t[c] for t in tables]) for c in ("anchor", "run", "start", "length")}
        order = np.lexsort((table["start"], owner[:, 1], owner[:, 0]))
        owner, start = owner[order], table["start"][order]
        new = np.concatenate(([True], (owner[1:] != owner[:-1]).any(axis=1)))
        once = new | np.concatenate(([True], start[1:] != start[:-1]))  # rows that repeat have the same places
        owner, new, order = owner[once], new[once], order[once]
        first = np.flatnonzero(new)
        offsets = pa.array(np.append(first, len(owner)).astype(np.int32))
        table = {c: v[order] for c, v in table.items()}
        lists = (table["anchor"].view(np.int64), table["run"].view(np.int64), table["start"].astype(np.int32),
                 table["length"].astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(owner[first, 0]), pa.array(owner[first, 1])]
            + [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in lists],
            ["key", "doc_id", "anchors", "runs", "starts", "lengths"])

    held: list[dict] = []
    for batch in batches:
        for m in batch.to_pylist():
            if held and held[0]["round"] != m["round"]:
                yield documents(held)
                held = []
            held.append(m)
    if held:
        yield documents(held)


def repeated_places(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """key, doc_id, anchors, runs, starts, lengths: runs of ``docs`` (key, doc_id, body) whose anchor occurs
    more than once.  A row of ``docs`` has at most one."""
    size = docs.agg(F.sum(F.octet_length("body").cast("long"))).first()[0] or 0
    n = max(shuffle_partitions(docs.sparkSession), -(-size // PER_OWNER))
    sent = docs.select("key", "doc_id", "body").mapInArrow(_send(n, window, anchor), _MESSAGES)
    local = F.col("kind") == 0
    dealt = sent.repartition(n, F.when(local, F.col("round")).otherwise(F.col("owner")), local)
    answers = dealt.sortWithinPartitions(~local, "owner").mapInArrow(_answer, _MESSAGES)
    rounds = answers.repartition(shuffle_partitions(docs.sparkSession), "round").sortWithinPartitions("round")
    return rounds.mapInArrow(_merged, _PLACES)


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bodies compressed before they are shuffled."""
    codec = pa.Codec("zstd", compression_level=1)
    for part in slices(batches):
        bodies = part.column("body").to_pylist()
        packed = [codec.compress(b, asbytes=True) for b in bodies]
        yield pa.RecordBatch.from_arrays(
            [part.column("key"), part.column("doc_id"), pa.array(map(len, bodies), pa.int64()), pa.array(packed, pa.binary())],
            ["key", "doc_id", "size", "packed"])


def _bodies(part: pa.RecordBatch) -> list[bytes]:
    codec = pa.Codec("zstd")
    return [codec.decompress(p, n, asbytes=True) if n else b"" for p, n in zip(
        part.column("packed").to_pylist(), part.column("size").to_pylist())]


def _cut(window: int):
    """Runs of documents, cut from their texts."""
    types = (("anchor", pa.int64()), ("run", pa.int64()), ("words", pa.binary()), ("doc_id", pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "size", 2 << 20):
            anchor, runs, texts, ids = [], [], [], []
            columns = (part.column(c).to_pylist() for c in ("doc_id", "places"))
            for body, doc_id, places in zip(_bodies(part), *columns):
                words = body.split()
                joined = b" ".join(words)
                ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
                for place in places:
                    anchor += place["anchors"]
                    runs += place["runs"]
                    texts += [joined[ends[a - 1] + 1 if a else 0:ends[a + m + window - 2]]
                              for a, m in zip(place["starts"], place["lengths"])]
                    ids += [doc_id] * len(place["starts"])
            if texts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, (_, t) in zip((anchor, runs, texts, ids), types)], [n for n, _ in types])

    return run


class _Automaton:
    """Suffix automaton of several word sequences; each state knows the first sequence's label it occurs in."""

    __slots__ = ("next", "link", "size", "label")

    def __init__(self):
        self.next, self.link, self.size, self.label = [{}], [-1], [0], [None]

    def __len__(self):
        return len(self.next)

    def _state(self, following: dict, link: int, size: int, label) -> int:
        self.next.append(following)
        self.link.append(link)
        self.size.append(size)
        self.label.append(label)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word) -> int:
        """State of the words of ``p`` + ``word``, taken out of ``q``."""
        nxt, size = self.next, self.size
        if size[p] + 1 == size[q]:
            return q
        clone = self._state(dict(nxt[q]), self.link[q], size[p] + 1, self.label[q])
        self.link[q] = clone
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list, label) -> None:
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for word in words:
            p = last
            if word in nxt[p]:
                last = self._split(p, nxt[p][word], word)
                continue
            last = self._state({}, 0, size[p] + 1, label)
            while p >= 0 and word not in nxt[p]:
                nxt[p][word] = last
                p = link[p]
            if p >= 0:
                link[last] = self._split(p, nxt[p][word], word)

    def windows(self, words: list, window: int) -> list:
        """Label of the first sequence that has each window; None where there is none."""
        nxt, link, size, label = self.next, self.link, self.size, self.label
        out, state, matched = [], 0, 0
        for i, word in enumerate(words):
            while state and word not in nxt[state]:
                state = link[state]
                matched = size[state]
            if word in nxt[state]:
                state, matched = nxt[state][word], matched + 1
            if i >= window - 1:
                at = state if matched >= window else 0
                while at and size[link[at]] >= window:
                    at = link[at]
                out.append(label[at])
        return out


def _match(window: int):
    """Distinct runs, sorted by (anchor, first doc), with the windows that a smaller document has."""
    names = ["anchor", "run", "first", "marks"]

    def matched(words: list[bytes], first: int, automaton: _Automaton) -> list[int]:
        """Offsets of windows seen in a smaller document; spans not seen are added."""
        labels = automaton.windows(words, window)
        at = 0
        while at < len(labels):
            stop = at
            while stop < len(labels) and labels[stop] is None:
                stop += 1
            if stop > at:
                automaton.add(words[at:stop + window - 1], first)
            at = stop + 1
        return [i for i, label in enumerate(labels) if label is not None and label < first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, before, alone = _Automaton(), None, True
        for batch in batches:
            marks = []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "first", "words"))
            for row in zip(*columns):
                found = None
                if before is None or row[0] != before[0]:
                    alone = True
                    if len(automaton) > 2 * SHARD:
                        automaton = _Automaton()
                else:
                    if alone:  # an anchor's first run is only added when another one follows
                        matched(before[2].split(), before[1], automaton)
                        alone = False
                    found = matched(row[2].split(), row[1], automaton) or None
                marks.append(found)
                before = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names[:3]] + [pa.array(marks, pa.list_(pa.int32()))], names)

    return run


def _windows(window: int):
    """Runs to single windows."""
    names = ["anchor", "run", "offset", "first", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = row["words"].split()
                out.extend((row["anchor"], row["run"], i, row["first"], b" ".join(words[i:i + window]))
                           for i in range(len(words) - window + 1))
            if out:
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return run


def _single_windows(runs: DataFrame, window: int) -> DataFrame:
    """Like ``_match`` for the runs of anchors that stand in very many contexts: window by window, so that
    no shard grows with them.  Equal windows of a task are merged before the shuffle."""
    windows = runs.mapInArrow(_windows(window), "anchor long, run long, offset int, first long, words binary")
    windows = stored(windows, "windows")
    least = windows.groupBy("words").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("rows"))
    found = attach(windows, stored(least, "least"), ["words"], "rows", windows.count()).filter("least < first")
    marks = found.groupBy("anchor", "run").agg(F.collect_list("offset").alias("marks"))
    return runs.select("anchor", "run", "first").join(marks, ["anchor", "run"], "left")


def _keep(window: int):
    names = ["doc_id", "n_words", "n_removed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "size", 4 << 20):
            out = []
            for body, doc_id, spans in zip(_bodies(part), *(part.column(c).to_pylist() for c in ("doc_id", "spans"))):
                words = body.split()
                kept, at, removed = [], 0, 0
                for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
                    kept.extend(words[at:start])
                    removed += max(0, stop - max(at, start))
                    at = max(at, stop)
                kept.extend(words[at:])
                out.append((doc_id, len(words), removed, b" ".join(kept)))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return run


def _spans(rows: DataFrame, window: int) -> DataFrame:
    """key, start, stop of covered words. ``rows``: occurrences with first (smallest doc_id of the run) and marks."""
    whole = F.array(F.struct(F.col("start"), (F.col("start") + F.col("n") + (window - 1)).alias("stop")))
    single = F.transform(F.coalesce("marks", F.array().cast("array<int>")), lambda i: F.struct(
        (F.col("start") + i).alias("start"), (F.col("start") + i + window).alias("stop")))
    spans = F.when(F.col("doc_id") > F.col("first"), whole).otherwise(single)
    return rows.select("key", F.inline(spans))


def remove_repeats(docs: DataFrame, window: int = 13, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one space, as bytes) of every row."""
    n = shuffle_partitions(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, F.lit(_LAST)).alias("doc_id"), text_bytes().alias("body"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "body"))
    places = stored(repeated_places(rows, window, anchor), "places")
    fields = ("anchors", "runs", "starts", "lengths")
    grouped = places.groupBy("key").agg(F.collect_set(F.struct(*fields)).alias("places"))
    texts = rows.mapInArrow(_squeeze, "key long, doc_id long, size long, packed binary")
    found = texts.join(grouped, "key").select("doc_id", "size", "packed", "places")
    runs = found.mapInArrow(_cut(window), "anchor long, run long, words binary, doc_id long")
    refs = stored(runs.groupBy("anchor", "run", "words").agg(F.min("doc_id").alias("first")), "runs")
    large = stored(refs.groupBy("anchor").count().filter(F.col("count") > RUNS).select("anchor"), "large")
    if large.count() <= BROADCAST_ANCHORS:
        large = F.broadcast(large)
    shards = refs.join(large, "anchor", "left_anti").repartition(n, "anchor").sortWithinPartitions("anchor", "first")
    matched = shards.mapInArrow(_match(window), "anchor long, run long, first long, marks array<int>")
    matched = stored(matched.unionByName(_single_windows(refs.join(large, "anchor", "left_semi"), window)), "matched")
    each = places.select("key", "doc_id", F.inline(F.arrays_zip(*fields)))
    each = each.select("key", "doc_id", F.col("anchors").alias("anchor"), F.col("runs").alias("run"),
                       F.col("starts").alias("start"), F.col("lengths").alias("n"))
    spans = _spans(each.join(matched, ["anchor", "run"]), window)
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    kept = texts.join(spans, "key", "left").select("doc_id", "size", "packed", "spans").mapInArrow(
        _keep(window), "doc_id long, n_words long, n_removed long, kept binary")
    return kept.withColumn("doc_id", F.when(F.col("doc_id") != _LAST, F.col("doc_id")))
