"""Alignment of two tokenizers over the same texts, with corpus counts of aligned id pairs.

A text is encoded as space+text by a byte-level vocabulary (A) and by a piece
model (B).  Byte offsets where tokens of both end cut the text into groups;
every A token is linked with every B token of its group.  An id pair's count is
the number of documents that hold it linked.

1. First pass.  A task cuts its rows into chunks of about ``CHUNK`` bytes,
   encodes and aligns them, and stores each chunk's ids and, for every shard of
   A ids, a message with its distinct pairs and how many of its documents hold
   each.
2. Each shard's distinct pairs are joined in a tree and get a minimal perfect
   hash.  Messages become dense count vectors indexed by it, which are summed
   in a tree.  A hash gives a number to any key, so the table keeps the keys
   and compares them.
3. The shards answer every message with the counts of its pairs, and with
   whether each is the highest of its A id (an A id's pairs are all in one
   shard).
4. Second pass.  Chunks meet their answers, documents are aligned again and
   their links look up the counts.

No table of pairs is broadcast: what a task holds is one shard and one message,
or one chunk and its own pairs.

Both vocabularies begin a new token at a single space between two other
characters, so texts are cut there, and a chunk encodes each distinct piece once.

Defined results: null and empty texts, and texts whose joined A or B tokens
differ from space+text (for B: those with U+2581), have no tokens; their
numbers are 0 and ``groups`` is empty.  Rows that repeat count as documents of
their own; a null id is carried; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import batched, chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shuffle_partitions, slices, stored, text_bytes
from .packed import pack, pack_unordered, unpack, unpack_unordered
from .perfect_hash import PerfectHash
from .tokens import encoder

#: Bytes of text in a chunk.
CHUNK = 2 << 20
#: Bytes of pieces that are encoded at a time.
JOINED = 64 << 10
#: Shards of A ids.
SHARDS = 256
#: Messages or vectors that one step of a tree joins.
FAN = 64
#: Links of one group that are listed one by one; larger groups are counted by distinct pairs.
GROUP = 64

_ROWS = "kind int, chunk long, ids array<long>, pieces array<binary>, shard long, pairs binary, counts binary"
_SCHEMA = pa.schema([
    ("kind", pa.int32()), ("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.binary())),
    ("shard", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary())])
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups binary"

_TWO_BLANKS = re.compile(r"\s\s")
_BYTE = re.compile("<0x[0-9A-F]{2}>")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str) -> list[str]:
    """A text cut at single spaces between two other characters (the spaces go)."""
    if not text:
        return []
    if text[0].isspace() or text[-1].isspace() or _TWO_BLANKS.search(text):
        return _CUT.split(text)
    return text.split(" ")


class Vocabularies:
    """Both tokenizers: ids and token bytes."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.encode_a = encoder(a_path)
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.bytes_a = _bytes_of(a_path)
        self.bytes_b = [self._piece(i) for i in range(self.model.get_piece_size())]
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        self.digits_a, self.digits_b = _digits(len(self.bytes_a)), _digits(len(self.bytes_b))

    def _piece(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if _BYTE.fullmatch(piece) and self.model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()


@cache
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def _bytes_of(path: str) -> list[bytes]:
    """Token bytes by id of a rank file."""
    import base64

    with open(path, "rb") as lines:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [found[i] for i in range(len(found))]


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to n - 1 as rows of bytes with room for a separator, and how many they are."""
    text = [str(i).encode() for i in range(n)]
    sizes = np.array([len(t) for t in text], np.int64)
    width = int(sizes.max()) + 1
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in text), np.uint8).reshape(n, width), sizes


def encode(words: list[str], v: Vocabularies) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of pieces under both vocabularies, how many each piece has, and which pieces' tokens give back their bytes
    (the others have no ids)."""
    raw = [b" " + w.encode() for w in words]
    ids_a, n_a = _encode_joined(words, raw, v.sizes_a, lambda text: v.encode_a(" " + text))
    ids_b, n_b = _encode_joined(words, raw, v.sizes_b, lambda text: v.model.encode(text))
    right = np.ones(len(words), bool)
    for ids, n, tokens in ((ids_a, n_a, v.bytes_a), (ids_b, n_b, v.bytes_b)):
        if b"".join(map(tokens.__getitem__, ids.tolist())) != b"".join(raw):
            stops = np.cumsum(n)
            for k, (x, y) in enumerate(zip((stops - n).tolist(), stops.tolist())):
                right[k] &= b"".join(map(tokens.__getitem__, ids[x:y].tolist())) == raw[k]
    if not right.all():
        ids_a, ids_b = ids_a[np.repeat(right, n_a)], ids_b[np.repeat(right, n_b)]
        n_a, n_b = n_a * right, n_b * right
    return ids_a, n_a, ids_b, n_b, right


def _encode_joined(words: list[str], raw: list[bytes], sizes: np.ndarray, one) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their number by piece.  Pieces are encoded many at a time, joined by the spaces at which they were cut;
    those that this does not give back byte by byte are encoded alone."""
    ids, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    stops = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
    for at, stop in _spans(stops, JOINED):
        some, ends = words[at:stop], stops[at:stop] - (stops[at - 1] if at else 0)
        text = " ".join(some)
        if not _TWO_BLANKS.search(f" {text} ") or not any(w[:1].isspace() or w[-1:].isspace() for w in some):
            found = np.array(one(text), np.int64)
            closed = np.cumsum(sizes[found])
            cuts = np.searchsorted(closed, ends)
            if len(closed) and closed[-1] == ends[-1] and np.array_equal(closed[cuts], ends):
                ids.append(found)
                counts.append(np.diff(cuts + 1, prepend=0))
                continue
        single = [one(w) for w in some]
        ids.append(np.fromiter(chain.from_iterable(single), np.int64))
        counts.append(np.fromiter(map(len, single), np.int64, len(some)))
    return np.concatenate(ids), np.concatenate(counts)


def _spans(stops: np.ndarray, budget: int) -> Iterator[tuple[int, int]]:
    """Runs of items of about ``budget`` bytes; ``stops``: where each ends."""
    at = 0
    while at < len(stops):
        stop = max(at + 1, int(np.searchsorted(stops, (stops[at - 1] if at else 0) + budget, "right")))
        yield at, stop
        at = stop


class Aligned:
    """Distinct pieces, aligned: numbers, links and group texts by piece."""

    def __init__(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, v: Vocabularies, texts: bool):
        self.n_a, self.n_b = n_a, n_b
        end_a, end_b = np.cumsum(v.sizes_a[a]), np.cumsum(v.sizes_b[b])
        marks = np.zeros(int(end_a[-1]) + 1 if len(a) else 1, np.int8)
        marks[end_a] += 1
        marks[end_b] += 1
        before = np.cumsum(marks == 2) - (marks == 2)  # common ends before each byte offset: the group of a token that ends there
        group_a, group_b = before[end_a], before[end_b]
        n = int(group_a[-1]) + 1 if len(a) else 0
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        owner = np.repeat(np.arange(len(n_a)), n_a)  # piece of each A token; a group's piece is that of its first
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        piece = owner[first_a]
        self.n_groups = np.bincount(piece, minlength=len(n_a))
        self._link(a, b, in_a, in_b, first_a, first_b, piece, len(v.bytes_b))
        if texts:
            self._write(v, a, b, group_a, group_b, in_a, in_b)

    def _link(self, a, b, in_a, in_b, first_a, first_b, piece, width) -> None:
        links = in_a * in_b
        small = links <= GROUP
        total = np.where(small, links, 0)
        group = np.repeat(np.arange(len(links)), total)
        k = np.arange(int(total.sum())) - np.repeat(np.cumsum(total) - total, total)
        pairs = [a[first_a[group] + k // in_b[group]] * width + b[first_b[group] + k % in_b[group]]]
        owners, weights = [piece[group]], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(~small).tolist():
            x, n_x = np.unique(a[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
            y, n_y = np.unique(b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
            pairs.append((x[:, None] * width + y).ravel())
            weights.append((n_x[:, None] * n_y).ravel())
            owners.append(np.full(len(pairs[-1]), piece[g]))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        self.distinct, self.pair = np.unique(np.concatenate(pairs)[order], return_inverse=True)
        self.weight = np.concatenate(weights)[order]
        self.sizes = np.bincount(owner, minlength=len(self.n_a))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _write(self, v, a, b, group_a, group_b, in_a, in_b) -> None:
        """``a1,a2|b1;`` by group, in order."""
        place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
        place_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
        width = max(v.digits_a[0].shape[1], v.digits_b[0].shape[1])
        cells = np.zeros((len(a) + len(b), width), np.uint8)
        sizes = np.empty(len(cells), np.int64)
        for ids, place, group, (digits, lengths), last in ((a, place_a, group_a, v.digits_a, b"|"),
                                                           (b, place_b, group_b, v.digits_b, b";")):
            cells[place, :digits.shape[1]] = digits[ids]
            ends = np.full(len(ids), ord(","), np.uint8)
            ends[np.diff(group, append=-1) != 0] = last[0]
            cells[place, lengths[ids]] = ends
            sizes[place] = lengths[ids] + 1
        flat = cells.ravel()
        text = flat[flat != 0].tobytes()
        stops = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))].tolist()
        self.texts = [text[x:y] for x, y in zip(stops, stops[1:])]

    def links_of(self, some: np.ndarray) -> np.ndarray:
        """Positions of the links of pieces."""
        sizes = self.sizes[some]
        return np.repeat(self.starts[some] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def _numbered(texts: list[str]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct pieces of texts, and each text's as numbers."""
    numbers: dict[str, int] = defaultdict(count().__next__)
    found = [np.fromiter(map(numbers.__getitem__, p), np.int64, len(p)) for p in map(pieces, texts)]
    return list(numbers), found


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def _first_pass(a_path: str, b_path: str):
    """Texts to chunks (kind 1) and messages to shards (kind 2)."""

    def flush(chunk: int, ids: list, texts: list[str]) -> pa.RecordBatch:
        v = vocabularies(a_path, b_path)
        words, found = _numbered(texts)
        a, n_a, b, n_b, right = encode(words, v)
        if not right.all():
            found = [f if right[f].all() else f[:0] for f in found]
        aligned = Aligned(a, n_a, b, n_b, v, texts=False)
        counts = np.zeros(len(aligned.distinct), np.int64)
        held = np.zeros(len(counts), bool)
        for f in found:
            if len(f):
                held[:] = False
                held[aligned.pair[aligned.links_of(np.unique(f))]] = True
                counts += held
        some = counts > 0
        pairs, counts = aligned.distinct[some], counts[some]
        shard = pairs // len(v.bytes_b) % SHARDS
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(SHARDS + 1)).tolist()
        rows = [{"kind": 2, "chunk": chunk, "shard": s, "pairs": pack(pairs[order[x:y]]), "counts": pack(counts[order[x:y]])}
                for s, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        rows.append({"kind": 1, "chunk": chunk, "ids": ids, "pieces": [
            pack_unordered(x) for x in (sizes, np.concatenate([np.empty(0, np.int64), *found]), a, n_a, b, n_b)]})
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0
        for part in slices(batches, budget=CHUNK):
            for doc_id, body in zip(part.column("doc_id").to_pylist(), part.column("body").to_pylist()):
                ids.append(doc_id)
                texts.append(body.decode())
                held += len(body) + 16
                if held >= CHUNK:
                    yield flush(chunk, ids, texts)
                    chunk, ids, texts, held = chunk + 1, [], [], 0
        if ids:
            yield flush(chunk, ids, texts)

    return run


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows by runs of equal ``columns``, one row at a time."""
    from itertools import groupby

    rows = (b.slice(i, 1).to_pylist()[0] for b in batches for i in range(b.num_rows))
    return groupby(rows, key=lambda r: tuple(r[c] for c in columns))


def _join_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of a branch of a shard."""
    for (shard, branch), rows in _runs(batches, ["shard", "branch"]):
        keys = np.empty(0, np.uint64)
        for some in batched(rows, 16):
            keys = np.unique(np.concatenate([keys, *(unpack(r["pairs"]) for r in some)]))
        yield pa.RecordBatch.from_pylist([{"shard": shard, "branch": branch, "pairs": pack(keys)}])


def _hash_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's pairs to its perfect hash and the pairs in order of their numbers."""
    for batch in batches:
        for shard, code in zip(batch.column("shard").to_pylist(), batch.column("pairs").to_pylist()):
            keys = unpack(code)
            table = PerfectHash.build(keys)
            held = np.empty_like(keys)
            held[table.numbers(keys)] = keys
            yield pa.RecordBatch.from_pylist([{"shard": shard, "hash": table.dump(), "keys": held.tobytes()}])


def _join_and_hash_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last join of a shard's pairs, and its hash, in one worker: a second one per task would stay with the
    executor and hold the vocabularies too in the second pass."""
    return _hash_keys(_join_keys(batches))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's table (kind 0), then a branch of its messages, to the branch's dense count vector."""
    for (shard, branch), rows in _runs(batches, ["shard", "branch"]):
        table = PerfectHash.load(next(rows)["hash"])
        counts = np.zeros(table.size, np.uint64)
        for row in rows:
            counts[table.numbers(unpack(row["pairs"]))] += unpack(row["counts"])
        yield pa.RecordBatch.from_pylist([{"shard": shard, "branch": branch, "counts": pack(counts)}])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of a branch, added up."""
    for (shard, branch), rows in _runs(batches, ["shard", "branch"]):
        total = unpack(next(rows)["counts"])
        for row in rows:
            total = total + unpack(row["counts"])
        yield pa.RecordBatch.from_pylist([{"shard": shard, "branch": branch, "counts": pack(total)}])


def _answers(width: int):
    """A shard's table (kind 0), then messages, to answers: twice the count, plus 1 where it is its A id's highest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, ["shard", "branch"]):
            first = next(rows)
            table, keys, counts = PerfectHash.load(first["hash"]), np.frombuffer(first["keys"], np.uint64), unpack(first["counts"])
            ids, at = np.unique(keys // np.uint64(width), return_inverse=True)
            highest = np.zeros(len(ids), np.uint64)
            np.maximum.at(highest, at, counts)
            coded = counts * np.uint64(2) + (counts == highest[at])
            for some in batched(rows, 64):
                out = []
                for row in some:
                    asked = unpack(row["pairs"])
                    number = table.numbers(asked)
                    if not np.array_equal(keys[number], asked):
                        raise ValueError("a pair is not in its shard's table")
                    out.append({"kind": 0, "chunk": row["chunk"], "pairs": row["pairs"], "counts": pack(coded[number])})
                yield _batch(out)

    return run


def _second_pass(a_path: str, b_path: str):
    """A chunk's answers (kind 0), then its texts (kind 1), to rows."""
    names = [c.split()[0] for c in _RESULT.split(", ")]
    types = [pa.int64()] * 7 + [pa.binary()]

    def documents_of(row: dict, answers: list) -> Iterator[tuple]:
        v = vocabularies(a_path, b_path)
        sizes, found, *encoded = (unpack_unordered(x).astype(np.int64) for x in row["pieces"])
        aligned = Aligned(*encoded, v, texts=True)
        stops = np.cumsum(sizes)
        n = len(aligned.n_a)
        coded = np.zeros(len(aligned.distinct), np.int64)
        for pairs, counts in answers:
            at = np.searchsorted(aligned.distinct, pairs)
            coded[at] = counts
        owner = np.repeat(np.arange(n), aligned.sizes)
        per_piece = [aligned.n_a, aligned.n_b, aligned.n_groups]
        for w in (np.ones(len(coded), np.int64), coded & 1, coded >> 1):
            sums = np.zeros(n, np.int64)
            np.add.at(sums, owner, aligned.weight * w[aligned.pair])
            per_piece.append(sums)
        table = np.stack(per_piece, axis=1)
        for doc_id, x, y in zip(row["ids"], (stops - sizes).tolist(), stops.tolist()):
            f = found[x:y]
            groups = b"".join(map(aligned.texts.__getitem__, f.tolist()))[:-1]
            yield doc_id, *table[f].sum(axis=0).tolist(), groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, ["chunk"]):
            answers = []
            for row in rows:
                if row["kind"] == 0:
                    answers.append((unpack(row["pairs"]).astype(np.int64), unpack(row["counts"]).astype(np.int64)))
                    continue
                out, held = [], 0
                for result in documents_of(row, answers):
                    out.append(result)
                    held += len(result[-1]) + 64
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return run


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (``a1,a2|b1;a3|b2,b3`` as bytes) of every row
    of ``docs`` (doc_id, text).  ``a_path``: rank file of A; ``b_path``: piece model of B."""
    parts = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    read = stored(rows.mapInArrow(_first_pass(a_path, b_path), _ROWS), "aligned")
    texts, messages = read.filter("kind = 1").select("chunk", "kind", "ids", "pieces"), read.filter("kind = 2")
    chunks = texts.count()

    def by_branch(df: DataFrame, *first: str) -> DataFrame:
        return df.repartition(parts, "shard", "branch").sortWithinPartitions("shard", "branch", *first)

    def tree(df: DataFrame, step, schema: str, branches: int) -> DataFrame:
        """``step`` over rows by shard and branch, ``FAN`` branches at a time, until each shard has one."""
        while branches > 1:
            branches = -(-branches // FAN)
            df = by_branch(df.withColumn("branch", F.floor(F.col("branch") / FAN).cast("long"))).mapInArrow(step, schema)
        return df

    branches = max(1, -(-chunks // FAN))
    messages = messages.select("shard", F.pmod(F.xxhash64("chunk"), F.lit(branches)).alias("branch"), "chunk", "pairs", "counts")
    keys, left = messages.select("shard", "branch", "pairs"), branches
    while left > 1:
        keys, left = by_branch(keys).mapInArrow(_join_keys, "shard long, branch long, pairs binary"), -(-left // FAN)
        keys = keys.withColumn("branch", F.floor(F.col("branch") / FAN).cast("long"))
    tables = stored(by_branch(keys).mapInArrow(_join_and_hash_keys, "shard long, hash binary, keys binary"), "hashes")

    def with_messages(table: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(branches - 1).cast("long"))).alias("branch")
        first = table.select("*", every, F.lit(0).alias("kind"))
        return by_branch(first.unionByName(messages.withColumn("kind", F.lit(1)), allowMissingColumns=True), "kind")

    vectors = with_messages(tables.select("shard", "hash")).mapInArrow(_vectors, "shard long, branch long, counts binary")
    vectors = tree(vectors, _add, "shard long, branch long, counts binary", branches)
    counted = stored(tables.join(vectors.select("shard", "counts"), "shard"), "counts")
    width = len(vocabularies(a_path, b_path).bytes_b)
    answers = with_messages(counted).mapInArrow(_answers(width), _ROWS).select("chunk", "kind", "pairs", "counts")
    both = answers.unionByName(texts, allowMissingColumns=True)
    both = both.repartition(max(parts, chunks), "chunk").sortWithinPartitions("chunk", "kind")
    return both.mapInArrow(_second_pass(a_path, b_path), _RESULT)
