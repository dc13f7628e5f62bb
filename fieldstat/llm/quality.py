"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of about ``PASSAGE`` words.  Every passage of
the whole text becomes a vector of surface statistics (kinds of bytes, word
lengths, repetition), which a small network encodes.  Gated attention (Ilse,
Tomczak and Welling, 2018) weighs the passages, and the weighted sum is scored.
Only document labels are used to learn: attention finds the passages that
decide.

The fit uses at most ``SAMPLE`` labelled documents outside the held-out third
(the smallest hashes of doc_id, so the choice is stable), each with all its
passages; of very long ones fewer, so that all have at most ``TOTAL`` passages
(one document is taken whatever its length).  Both bounds concern the fit alone.
Scoring reads all passages, in tasks, without a shuffle.

Defined results: a null or empty text is one empty passage and is scored; null
labels are no labels, several labels of a doc_id count by their mean; a null
doc_id is not held out and cannot be labelled; without any usable label every
score is 0.5 (nothing is rejected); repeated rows get equal scores; other
columns are ignored by ``score`` and carried by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, stored, text_bytes

PASSAGE = 64
SAMPLE = 6000
TOTAL = 384_000
STEP = 1 << 15
HIDDEN = 24
GATES = 12
EPOCHS = 60


def _classes() -> np.ndarray:
    kinds = np.zeros(256, np.int64)  # 0: anything else below 0x80
    kinds[ord("a"):ord("z") + 1] = 1
    kinds[ord("A"):ord("Z") + 1] = 2
    kinds[ord("0"):ord("9") + 1] = 3
    kinds[0x80:] = 4
    for k, chars in enumerate((b" ", b"\t\v\f", b"\r\n", b".,;:", b"!?", b"'\"()-", b"|", b"#$%&*@^~", b"<>{}[]=+_/\\"), 5):
        kinds[list(chars)] = k
    return kinds


_KIND = _classes()
_KINDS = int(_KIND.max()) + 1
FEATURES = _KINDS + 9


def passages(body: bytes) -> np.ndarray:
    """One row of statistics per passage of a text."""
    words = body.split()
    n = len(words)
    if n == 0:
        return np.zeros((1, FEATURES))
    lengths = np.fromiter(map(len, words), np.int64, n)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    count = -(-n // PASSAGE)
    first = np.arange(count) * n // count
    sizes = np.diff(np.append(first, n))
    data = np.frombuffer(body, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    edges = np.append(starts[first], len(data))
    edges[0] = 0
    spans = np.diff(edges)
    cell = np.repeat(np.arange(count) * _KINDS, spans) + _KIND[data]
    kinds = np.bincount(cell, minlength=count * _KINDS).reshape(count, _KINDS)
    part = np.repeat(np.arange(count), sizes)
    again = np.zeros(n)
    again[1:] = (hashes[1:] == hashes[:-1]) & (part[1:] == part[:-1])
    order = np.lexsort((hashes, part))
    new = np.ones(n, bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (part[1:] != part[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), n))
    most = np.maximum.reduceat(runs, np.searchsorted(np.flatnonzero(new), first))
    last = np.fromiter((w[-1] for w in words), np.int64, n)
    out = np.empty((count, FEATURES))
    out[:, :_KINDS] = np.sqrt(kinds / spans[:, None])
    mean = np.add.reduceat(lengths, first) / sizes
    out[:, _KINDS:] = np.stack([
        mean, np.sqrt(np.maximum(0, np.add.reduceat(lengths * lengths, first) / sizes - mean * mean)),
        np.add.reduceat(again, first) / sizes, np.add.reduceat(new.astype(float), first) / sizes, most / sizes,
        np.add.reduceat((_KIND[last] >= 10).astype(float), first) / sizes,
        np.add.reduceat((_KIND[last] == 9).astype(float), first) / sizes,
        np.log1p(sizes), np.full(count, np.log1p(n))], axis=1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Model:
    """Encoder, gated attention and score; learned by gradient steps (Adam) on document labels."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
        self.mean, self.scale = mean, scale
        self.p = {"W": draw(len(mean), HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATES), "U": draw(HIDDEN, GATES),
                  "w": draw(GATES, 1)[:, 0], "c": draw(HIDDEN, 1)[:, 0], "d": np.zeros(1)}

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        """``x``: passages of all documents; ``first``: where each document's passages begin."""
        p = self.p
        bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"])}

    def gradient(self, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict:
        p, f = self.p, self.forward(x, first)
        bag, h, t, s, a = f["bag"], f["h"], f["t"], f["s"], f["a"]
        dy = (f["y"] - label) / len(label)
        dz = np.outer(dy, p["c"])[bag]
        da = (dz * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, first)[bag])
        dg = np.outer(de, p["w"])
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de,
                "c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        first = np.cumsum([0] + [len(b) for b in bags[:-1]])
        return self.forward((np.concatenate(bags) - self.mean) / self.scale, first)["y"]


def _parts(chosen: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """``chosen`` in parts of about ``STEP`` passages, which bound the memory of a gradient."""
    return np.split(chosen, np.flatnonzero(np.diff(np.cumsum(sizes) // STEP)) + 1)


def train(bags: list[np.ndarray], labels: np.ndarray, batch: int = 256, rate: float = 5e-3) -> Model | None:
    """Model fitted to document labels; None if there are none to learn from."""
    if not len(bags):
        return None
    rows = np.concatenate(bags)
    model = Model(rows.mean(axis=0), rows.std(axis=0) + 1e-6)
    bags = [(b - model.mean) / model.scale for b in bags]
    rng, step = np.random.default_rng(1), 0
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(x) for k, x in model.p.items()}
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at:at + batch]
            g = {k: np.zeros_like(x) for k, x in model.p.items()}
            for some in _parts(chosen, [len(bags[i]) for i in chosen]):
                first = np.cumsum([0] + [len(bags[i]) for i in some[:-1]])
                part = model.gradient(np.concatenate([bags[i] for i in some]), first, labels[some])
                g = {k: x + part[k] * (len(some) / len(chosen)) for k, x in g.items()}
            step += 1
            now = rate * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k, x in model.p.items():
                d = g[k] + 1e-4 * x
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                x -= now * m[k] / (np.sqrt(v[k]) + 1e-8)
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        out = []
        for label, body in zip(part.column("label").to_pylist(), part.column("body").to_pylist()):
            rows = passages(body)
            out.append((label, len(rows), rows.astype(np.float32).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.float64(), pa.int64(), pa.binary()))],
                                         ["label", "n", "bag"])


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality") -> Model | None:
    """Model learned from ``labels`` (doc_id, ``column``) of documents that are not held out."""
    usable = labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    usable = usable.groupBy("doc_id").agg(F.avg(column).alias("label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.select("doc_id", text_bytes().alias("body")).join(F.broadcast(chosen), "doc_id")
    bags = rows.select("doc_id", "label", "body").mapInArrow(_bags, "label double, n long, bag binary")
    bags = stored(bags.withColumn("hash", F.xxhash64("bag")), "bags")
    sizes = [r["n"] for r in bags.select("hash", "label", "n").orderBy("hash", "label", "n").limit(SAMPLE).collect()]
    fitting = max(1, int(np.searchsorted(np.cumsum(sizes), TOTAL, "right")))
    sample = bags.orderBy("hash", "label", "n").limit(fitting).collect()
    return train([np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES).astype(np.float64) for r in sample],
                 np.array([r["label"] for r in sample]))


def _scores(model: Model | None, bodies: list[bytes]) -> np.ndarray:
    if model is None or not bodies:
        return np.full(len(bodies), 0.5)
    return model.scores([passages(b) for b in bodies])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, budget=2 << 20):
            found = _scores(model, part.column("body").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(found)],
                                             ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_bytes().alias("body"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """Rows of ``docs``, as they are, whose text scores at least 0.5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 2 << 20):
            bodies = [(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in part.column("text")]
            yield part.filter(pa.array(_scores(model, bodies) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
