"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every row gets a fingerprint of its normalised text (runs of ASCII white
   space become one space; null counts as empty).  The fingerprint has
   ``log2(rows) + SLACK_BITS`` bits, so about one unique text in
   ``2**SLACK_BITS`` becomes a false suspect, which step 4 clears.
2. Each task sends, to the owner of each fingerprint range, its sorted
   distinct fingerprints as one Golomb-Rice code, with a bit for those that it
   has twice itself.
3. Owners decode their messages and answer each with a bitmap: which of its
   fingerprints another message has too.  Message and bitmap meet again on
   (sender, owner) and give the suspects.
4. Only suspects' texts are shuffled: grouping by the text itself compares the
   bytes, and equal texts of one task are merged before the shuffle, so a text
   that a third of all rows repeat sends one row per task.

Defined results: null texts equal empty ones; a null doc_id sorts after every
other; rows that repeat both doc_id and text share the decision; an empty
table gives an empty table; other columns are ignored (``decisions``) or
carried (``deduplicate``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import golomb
from .common import attach, shuffle_partitions, stored
from .members import may_be_in

#: Fingerprint bits beyond log2(rows).
SLACK_BITS = 8
#: Fingerprints in one message round of a task.
ROUND = 1 << 20
#: Fingerprints for one owner, at most on average.
PER_OWNER = 2 << 20

_MESSAGES = "owner long, sender long, codes binary, twice binary"
_REPLIES = "owner long, sender long, known binary"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(column).cast("string"), F.lit("")), "[ \\t-\\r]+", " ")


def _fingerprint(text: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits)


def _send(bits: int, owners: int):
    span = -(-(1 << bits) // owners)

    def message(values: np.ndarray, sender: int) -> pa.RecordBatch:
        distinct, counts = np.unique(values, return_counts=True)
        cuts = np.searchsorted(distinct, np.arange(1, owners, dtype=np.uint64) * np.uint64(span))
        rows = []
        for owner, (part, n) in enumerate(zip(np.split(distinct, cuts), np.split(counts, cuts))):
            if len(part):
                local = part - np.uint64(owner * span)
                rows.append((owner, sender, golomb.encode(local, span), np.packbits(n > 1).tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
            ["owner", "sender", "codes", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sender, held, n = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            held.append(batch.column("fp").to_numpy(zero_copy_only=False).astype(np.uint64))
            n += len(held[-1])
            if n >= ROUND:
                yield message(np.concatenate(held), sender)
                sender, held, n = sender + 1, [], 0
        if n:
            yield message(np.concatenate(held), sender)

    return run


def _reply(messages: pa.Table) -> pa.Table:
    """One owner: which fingerprints of each message are in another one, or in it twice."""
    senders, codes, twice = (messages.column(c).to_pylist() for c in ("sender", "codes", "twice"))
    values = [golomb.decode(c) for c in codes]
    distinct, counts = np.unique(np.concatenate(values), return_counts=True)
    shared = distinct[counts > 1]
    known = []
    for v, t in zip(values, twice):
        at = np.searchsorted(shared, v)
        hit = np.zeros(len(v), bool) if not len(shared) else shared[np.minimum(at, len(shared) - 1)] == v
        known.append(np.packbits(hit | np.unpackbits(np.frombuffer(t, np.uint8), count=len(v)).astype(bool)).tobytes())
    return pa.table({"owner": messages.column("owner"), "sender": pa.array(senders, pa.int64()),
                     "known": pa.array(known, pa.binary())})


def _read_replies(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, codes, known in zip(*(batch.column(c).to_pylist() for c in ("owner", "codes", "known"))):
                values = golomb.decode(codes)
                hit = np.unpackbits(np.frombuffer(known, np.uint8), count=len(values)).astype(bool)
                found = values[hit] + np.uint64(owner * span)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64))], ["fp"])

    return run


def suspects(prints: DataFrame, bits: int, rows: int) -> DataFrame:
    """Distinct fingerprints (column ``fp`` of ``prints``, ``bits`` wide) that occur more than once."""
    spark = prints.sparkSession
    owners = max(shuffle_partitions(spark), -(-rows // PER_OWNER))
    span = -(-(1 << bits) // owners)
    messages = stored(prints.select("fp").mapInArrow(_send(bits, owners), _MESSAGES), "messages")
    replies = messages.groupBy("owner").applyInArrow(_reply, _REPLIES)
    answered = messages.select("owner", "sender", "codes").join(replies, ["owner", "sender"])
    return answered.select("owner", "codes", "known").mapInArrow(_read_replies(span), "fp long").distinct()


def _marked(docs: DataFrame, prints: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Each row of ``docs`` as the struct ``row`` (so that no name of its columns clashes) with text (normalised), fp and
    maybe (false: no suspect); the suspects' fingerprints; number of rows.

    A filter of bounded size tells suspects in the tasks that read the texts, so
    that of the others about one in a hundred is shuffled, however many suspects
    there are; the join with the list of suspects then decides.
    """
    rows = prints.count()
    bits = min(63, max(1, rows).bit_length() + SLACK_BITS)
    found = stored(suspects(prints.select(F.shiftrightunsigned("h", 64 - bits).alias("fp")), bits, rows), "suspects")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.select(row.alias("row"), normalised().alias("text")).withColumn("fp", _fingerprint(F.col("text"), bits))
    return marked.withColumn("maybe", may_be_in(F.col("fp"), found)), found, rows


def _prints(docs: DataFrame) -> DataFrame:
    text = docs.select("doc_id", normalised().alias("t"))
    return stored(text.select("doc_id", F.xxhash64("t").alias("h"), F.sha2("t", 256).alias("text_sha256")), "prints")


def decisions(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``."""
    prints = _prints(docs.select("doc_id", "text"))
    marked, found, rows = _marked(docs.select("doc_id", "text"), prints)
    groups = (
        marked.filter("maybe").join(found, "fp", "left_semi").groupBy("fp", "text")
        .agg(F.min("row.doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
        .select(F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    groups = stored(groups, "groups")
    return attach(prints, groups, ["h", "text_sha256"], "group_size", rows).select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("doc_id").eqNullSafe(F.col("keep_id")) | F.col("group_size").isNull(), F.lit(False)).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text: the one with the smallest doc_id."""
    marked, found, _ = _marked(docs, stored(docs.select(F.xxhash64(normalised()).alias("h")), "prints"))
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.xxhash64("row.text"))
    shared = marked.filter("maybe").join(found.withColumn("suspect", F.lit(True)), "fp", "left")
    first = shared.filter("suspect").groupBy("fp", "text").agg(F.min_by("row", order).alias("row"))
    alone = marked.filter("NOT maybe").select("row").unionByName(shared.filter("suspect IS NULL").select("row"))
    return alone.unionByName(first.select("row")).select("row.*")
