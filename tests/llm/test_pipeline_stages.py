import zlib

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from fieldstat.llm import quality, queries, secret_scan, stages
from fieldstat.llm.common import stored
from fieldstat.llm.tokens import tokenizer, vocabulary_path

from . import brute
from .conftest import edge_texts


def test_registered():
    found = entry.queries()
    assert [n for n in found if n.startswith("op")] == list(queries.QUERIES) and len(queries.QUERIES) == 13
    assert found["pipeline"] is corpus_pipeline.run and set(queries.SQL) <= set(queries.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "simhash near-dedup", "secret scans", "best-fit packing"]


def survivors(docs, scores):
    """Plain version of the first four stages: (doc_id, text) that stay, redacted."""
    docs = [(d, t) for (d, t), s in zip(docs, scores) if s >= 0.5]
    key = lambda x: (x[0] is None, x[0] or 0)
    first = {}
    for (d, t), row in zip(docs, brute.equal_texts(docs)):
        first[row[4]] = min(first.get(row[4], (d, t)), (d, t), key=key)
    docs = list(first.values())
    rows = brute.near_groups(docs)
    first = {}
    for (d, t), (_, _, c) in zip(docs, rows):
        first[c] = min(first.get(c, (d, t)), (d, t), key=key)
    return [(d, t and secret_scan._redacted(t, "<SECRET>")) for d, t in first.values()]


def pieces_of(docs, capacity=1024):
    coder, out = tokenizer(vocabulary_path("byte_bpe_50k.json")), []
    for d, t in docs:
        ids = np.array(coder.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        out += [(d, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return sorted(out, key=repr)


def test_pipeline_against_the_plain_version(spark, sf, sf_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    left = survivors(sf_docs, quality._scores(model, [t.encode() for _, t in sf_docs]))
    rows = corpus_pipeline.run(spark, sf).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == pieces_of(left)
    assert 0 < len(left) < len(sf_docs)


def test_stages_on_edges(spark, edges, sf):
    docs, names = edges, edges.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), "edge")
        assert docs.columns == names, name
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    assert left <= {d for d, _ in edge_texts()} and docs.count() > 5
    assert stages.pack_sequences(spark, docs, sf).count() >= docs.count()


def test_stages_on_no_documents(spark, no_docs, sf):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0
