"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts texts into chunks, so a passage that several
documents share gives equal chunks wherever it stands.  A cut moves to the next
white space where one follows within ``REACH`` bytes.  Each distinct chunk is
encoded once per task (its distinct words in one call of the library) and kept
while memory lasts; a document's ids are put together from its chunks.

Joins are then repaired.  A cut inside a word leaves half words on both sides:
the whole word is encoded again and replaces them.  Every other join is checked
by encoding its two words as one piece; where that differs from what has been
put together, the document is encoded as a whole.  The result equals the
encoding of the whole text.  Tokenizers that keep white space are refused: the
words of a chunk could not be put together from single encodings.

The caches live in the task's worker and are bounded, so nothing is shuffled
and a lost executor costs its tasks only.  Equal chunks of different tasks are
encoded once in each: sending ids to documents would shuffle more bytes than
the texts have.

Defined results: a null text is an empty one and has no ids; white-space texts
likewise; invalid UTF-8 is read with replacement characters; other columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, text_bytes
from .tokens import tokenizer

#: A chunk has about 2**CHUNK_BITS bytes.
CHUNK_BITS = 11
#: How far a cut may move to meet white space.
REACH = 256
#: Bytes (estimated) of chunks and words that a worker keeps.
KEPT = 128 << 20
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
_GEAR = ((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def cuts(body: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Content-defined cut positions inside ``body``, ascending."""
    if len(body) < 2:
        return []
    rolling = _GEAR[np.frombuffer(body, np.uint8)]
    for shift in (1, 2, 4, 8, 16):  # h[i] = sum of gear[b[i - k]] << k over 32 bytes
        older = np.zeros_like(rolling)
        older[shift:] = rolling[:-shift] << np.uint32(shift)
        rolling += older
    found = []
    for at in np.flatnonzero(rolling >> np.uint32(32 - bits) == 0).tolist():
        if space := _SPACE.search(body, at, at + REACH):
            at = space.start()
        while at < len(body) and body[at] & 0xC0 == 0x80:  # not inside a character
            at += 1
        if 0 < at < len(body) and (not found or at > found[-1]):
            found.append(at)
    return found


class ChunkCoder:
    """Encodes documents through chunks and words that are encoded once."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        probe = self._library([b"a", b"b", b"a \t\r\n b", b" "])
        if probe[0] + probe[1] != probe[2] or probe[3]:
            raise ValueError("the tokenizer keeps white space: its chunks can't be joined at words")
        self.words: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, tuple[int, bytes, bytes, bytes, bytes, bytes]] = {}
        self.held = 0

    def _library(self, pieces: list[bytes]) -> list[bytes]:
        found = self.library.encode_batch_fast([p.decode("utf-8", "replace") for p in pieces], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.words]
        self.words.update(zip(new, self._library(new)))
        self.held += sum(map(len, new)) + 150 * len(new)

    def _entry(self, chunk: bytes) -> tuple[int, bytes, bytes, bytes, bytes, bytes]:
        """Number of words, first and last word, ids of the first, of the inner ones and of the last."""
        if (entry := self.chunks.get(chunk)) is None:
            words, known = chunk.split(), self.words
            entry = (0, *[b""] * 5) if not words else (
                len(words), words[0], words[-1], known[words[0]], b"".join([known[w] for w in words[1:-1]]), known[words[-1]])
            self.chunks[chunk] = entry
            self.held += len(chunk) + sum(map(len, entry[1:])) + 200
        return entry

    def _join(self, chunks: list[bytes]) -> tuple[bytes, list[tuple[bytes, bytes]]]:
        """Ids of the chunks, words that a cut split encoded again; (last word, first word) of the other joins."""
        out: list[bytes] = []
        seams: list[tuple[bytes, bytes]] = []
        word, ids = b"", b""  # last word so far, not yet in ``out``; no ids: put together from several chunks
        split = False  # the next chunk may go on with it
        for chunk in chunks:
            n, first, last, first_ids, inner, last_ids = self._entry(chunk)
            if n == 0:
                split = False
                continue
            goes_on = split and not _SPACE.match(chunk)
            split = not _SPACE.match(chunk[-1:])
            if goes_on:
                word, ids = word + first, None
                if n == 1:
                    continue
                out.append(self._single(word))
            else:
                if word:
                    out.append(self._single(word) if ids is None else ids)
                    seams.append((word, first))
                if n == 1:
                    word, ids = first, first_ids
                    continue
                out.append(first_ids)
            out.append(inner)
            word, ids = last, last_ids
        out.append(self._single(word) if ids is None else ids)
        return b"".join(out), seams

    def _single(self, word: bytes) -> bytes:
        """Ids of a word that cuts had split."""
        if (ids := self.words.get(word)) is None:
            ids = self._library([word])[0]
        return ids

    def encode(self, bodies: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if self.held > KEPT:
            self.words, self.chunks, self.held = {}, {}, 0
        parts = []
        for body in bodies:
            at = [0, *cuts(body), len(body)]
            parts.append([body[a:b] for a, b in zip(at, at[1:])])
        self._learn({w for c in {c for p in parts for c in p} if c not in self.chunks for w in c.split()})
        joined = [self._join(p) for p in parts]
        seams = list({s for _, ss in joined for s in ss})
        around = self._library([left + b" " + right for left, right in seams])
        wrong = {s for s, got in zip(seams, around) if got != self._single(s[0]) + self._single(s[1])}
        return [self._library([body])[0] if wrong and not wrong.isdisjoint(ss) else ids
                for body, (ids, ss) in zip(bodies, joined)]

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


_CODERS: dict[str, ChunkCoder] = {}


def _code(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _CODERS.setdefault(path, ChunkCoder(path))
        for part in slices(batches, budget=2 << 20):
            ids = coder.encode(part.column("body").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array([coder.decode(i) for i in ids], pa.string())],
                ["doc_id", "ids", "decoded"])

    return run


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian 32-bit integers) and decoded text of every row; ``path``: tokenizer JSON file."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    return rows.mapInArrow(_code(path), "doc_id long, ids binary, decoded string")
