import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from fieldstat.llm import block_ann, quality, queries, warc

from . import brute
from .conftest import as_lists, edge_texts

PAGES = "page_id long, url string, html string, chunk string, record string, archive string, size string, sha1 string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, None, "x", None, "y", None) for r in rows], PAGES).repartition(3)


def page_rows():
    big = "<p>" + "é\r\n\r\nWARC/1.1\r\n" * 30_000
    return [(1, "u1", None), (2, None, ""), (3, "u3", "é" * 499), (4, "u4", "é" * 499), (5, "a\r\nb%0A", "x" * 1000),
            (9, "u9", "x" * 1000), (7, "u7", "x" * 1000), (8, "u8", big), (6, "u6", big), (None, "n", "x" * 1000),
            (None, None, "y" * 2000), (12, "u", "z" * 1500), (12, "v", "z" * 1500),
            (13, "null", "a"), (14, "%6Eull", "b"), (15, "null null", "c")]


def expected(rows):
    out = []
    for p, u, h in rows:
        body = (h or "").encode()
        same = [q for q, _, g in rows if (g or "").encode() == body and q is not None]
        revisit = len(body) >= 1000 and len([1 for _, _, g in rows if g == h]) > 1 and same and p != max(same)
        out.append((p, u, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response",
                    max(same) if revisit else None))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("chunk", [300, 1024, 64 << 10])
def test_warc_round_trip(spark, chunk):
    chunks = warc.write_archives(pages_of(spark, page_rows()), chunk_bytes=chunk)
    assert chunks.select(F.max(F.octet_length("data"))).first()[0] <= max(chunk, 600) + 4
    assert as_lists(warc.read_archives(chunks), *COLUMNS) == expected(page_rows())


def test_archives_are_warc_files(spark):
    """The chunks of an archive, put together, parse as WARC records one after another."""
    chunks = warc.write_archives(pages_of(spark, page_rows()), chunk_bytes=500).orderBy("archive", "record", "chunk").collect()
    data, n = b"".join(bytes(r.data) for r in chunks), 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        payload = rest[:size].partition(b"\r\n\r\n")[2]
        if fields["WARC-Type"] == "response":
            assert fields["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
        else:
            assert payload == b"" and fields["WARC-Refers-To"].startswith("<urn:page:")
        assert rest[size:size + 4] == b"\r\n\r\n"
        data, n = rest[size + 4:], n + 1
    assert n == len(page_rows())


def test_damage_is_noticed(spark):
    chunks = warc.write_archives(pages_of(spark, [(1, "u", "x" * 5000)]), chunk_bytes=1000)
    bad = chunks.withColumn("data", F.when(F.col("chunk") == 2, F.encode(F.lit("y" * 1000), "UTF-8")).otherwise(F.col("data")))
    with pytest.raises(Exception, match="digest differs"):
        warc.read_archives(bad).collect()


def test_no_pages(spark):
    assert warc.read_archives(warc.write_archives(pages_of(spark, page_rows()).limit(0))).count() == 0


def test_warc_query(spark, sf):
    rows = [(r.page_id, None, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = as_lists(queries.op1_chunked_warc(spark, sf), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == sorted(((p, *x) for p, _, *x in expected(rows)), key=repr)


def nearest_of(rows, k=5):
    """Exact search over (vec_id, vector) with the operator's rules."""
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, v in usable:
        if q % 50 == 0:
            others = [(i, w) for i, w in usable if i != q and len(w) == len(v)]
            scores = brute.cosines([w for _, w in others], v) if others else []
            ranked = sorted({(-s, i) for s, (i, _) in zip(scores, others)})[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,kind", [(2048, "float"), (3, "double")])
def test_nearest_on_edges(spark, monkeypatch, block, kind):
    monkeypatch.setattr(block_ann, "BLOCK", block)
    monkeypatch.setattr(block_ann, "QUERY_BLOCKS", 1)
    rng = np.random.default_rng(1)
    draw = lambda n, d: [[float(np.float32(x)) for x in row] for row in rng.normal(size=(n, d))]
    rows = list(enumerate(draw(300, 16)))
    rows += [(1000 + i, rows[50][1]) for i in range(20)]  # ties with a query
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [None] + [1.0] * 15), (2050, [float("nan")] * 16),
             (2100, [float("inf")] * 16), (None, [1.0] * 16), (3000, [1.0] * 3), (3001, [2.0, 2.0, 2.1]), (4000, [5.0])]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField(
        "embedding", T.ArrayType(T.FloatType() if kind == "float" else T.DoubleType())), T.StructField("dim", T.StringType())])
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], schema).repartition(4)
    got = sorted(map(tuple, block_ann.nearest(df, df.filter("vec_id % 50 = 0")).collect()))
    if kind == "float":
        rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = nearest_of(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-14)


def test_nearest_query_has_full_recall(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(map(tuple, queries.op9_block_matrix_ann(spark, sf).collect()))
    want = nearest_of(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    empty = spark.read.parquet(f"{sf}/embeddings.parquet").limit(0)
    assert block_ann.nearest(empty, empty).count() == 0


def test_int8_bounds_hold():
    rng = np.random.default_rng(2)
    for scale in (1, 1e-20, 1e18):
        make = lambda n: {"n": n, "dim": 70, "ids": np.arange(n).tobytes(),
                          "vectors": (rng.normal(size=(n, 70)) ** 3 * scale).tobytes()}
        q, c = (block_ann._Tile(make(n), "<f8") for n in (40, 50))
        near, off = block_ann._approximate(q, c)
        exact = (q.vectors / q.norms[:, None]) @ (c.vectors / c.norms[:, None]).T
        assert (np.abs(exact - near) <= off).all() and off.max() < 0.1


def test_gradients_by_differences():
    rng = np.random.default_rng(3)
    x, first, label = rng.normal(size=(9, 5)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])
    model = quality.Model(np.zeros(5), np.ones(5), seed=4)
    loss = lambda: -np.mean([np.log(p if y else 1 - p) for p, y in zip(model.forward(x, first)["y"], label)])
    for name, g in model.gradient(x, first, label).items():
        flat, grad = model.p[name].reshape(-1), np.reshape(g, -1)
        for i in range(0, len(flat), 7):
            old = flat[i]
            flat[i] = old + 1e-6
            up = loss()
            flat[i] = old - 1e-6
            down = loss()
            flat[i] = old
            assert grad[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_quality_held_out(spark, sf):
    sf = "/root/testdata/sf0.01"
    rows = queries.op10_mil_quality(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95 and len(held) > 50
    clean = [r.predicted for r in held if truth[r.doc_id] == 1]
    assert np.mean(clean) > 0.98


def test_held_out_labels_are_never_read(spark, sf):
    """Turning the held-out third's labels round changes nothing."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (as_lists(quality.score(docs, quality.fit(docs, x)), "doc_id", "score") for x in (labels, turned))
    assert a == b


def test_quality_on_edges(spark, edges, no_docs):
    labels = spark.createDataFrame([(4, 1), (4, 1), (4, None), (9, 0), (None, 1), (15, 1), (99, 0)], "doc_id long, quality int")
    model = quality.fit(edges, labels)
    rows = quality.score(edges, model).collect()
    assert len(rows) == len(edge_texts()) and all(0 <= r.score <= 1 for r in rows)
    assert quality.accepted(edges, model).schema == edges.schema
    assert quality.accepted(edges, model).count() == sum(r.predicted for r in rows)
    assert quality.fit(edges, labels.limit(0)) is None and quality.accepted(edges, None).count() == len(edge_texts())
    assert quality.score(no_docs, model).count() == 0 and quality.fit(no_docs, labels) is None


def test_passages_count_plainly():
    rng = random.Random(8)
    body = " ".join(rng.choice(["Ab,", "x", "x", "LOUD!!", "3", "é"]) for _ in range(150)).encode()
    rows, words = quality.passages(body), body.split()
    count = -(-len(words) // quality.PASSAGE)
    assert rows.shape == (count, quality.FEATURES)
    for k in range(count):
        part = words[k * len(words) // count:(k + 1) * len(words) // count]
        mean, _, again, distinct, most = rows[k, quality._KINDS:quality._KINDS + 5]
        assert mean == pytest.approx(np.mean([len(w) for w in part]))
        assert again == pytest.approx(sum(a == b for a, b in zip(part, part[1:])) / len(part))
        assert distinct == pytest.approx(len(set(part)) / len(part))
        assert most == pytest.approx(max(part.count(w) for w in part) / len(part))


def test_fit_reads_all_passages(spark, monkeypatch):
    rng = random.Random(12)
    texts = [(i, " ".join(rng.choice(("one", "two2", "Three!", "4")) for _ in range(n))) for i, n in enumerate((20_000, 5_000, 30, 9_000) * 3)]
    docs, labels = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(
        [(i, i % 2) for i, _ in texts], "doc_id long, quality int")
    learned = {r.doc_id for r in labels.filter(~quality.held_out()).collect()}
    want = sorted(len(quality.passages(t.encode())) for i, t in texts if i in learned)
    seen = []
    monkeypatch.setattr(quality, "train", lambda bags, labels: seen.append(sorted(map(len, bags))))
    quality.fit(docs, labels)
    assert seen == [want] and max(want) > 64
    monkeypatch.setattr(quality, "TOTAL", sum(want) // 2)
    quality.fit(docs, labels)
    assert 0 < len(seen[1]) < len(want) and sum(seen[1]) <= sum(want) // 2 and set(seen[1]) <= set(want)
    monkeypatch.setattr(quality, "TOTAL", 0)
    quality.fit(docs, labels)
    assert len(seen[2]) == 1


def test_gradients_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    bags = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 70, 3, 200, 5, 40)]
    labels = np.array([0, 1, 1, 0, 1, 0.5])
    monkeypatch.setattr(quality, "EPOCHS", 3)
    whole = quality.train(bags, labels).scores(bags)
    monkeypatch.setattr(quality, "STEP", 50)
    assert np.allclose(quality.train(bags, labels).scores(bags), whole)


def test_vectors_of_extreme_size(spark):
    rng = np.random.default_rng(9)
    plain = rng.normal(size=(40, 6))
    scale = np.array([1.0, 1e160, 1e-165, 1e300, 1e-300])[np.arange(40) % 5]
    frame = lambda rows: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    want, got = (sorted((r.query_id, r.rank, r.vec_id, r.score) for r in block_ann.nearest(f, f).collect())
                 for f in (frame(plain), frame(plain * scale[:, None])))
    assert [r[:3] for r in got] == [r[:3] for r in want] and len(got) == 200
    assert np.allclose([r[3] for r in got], [r[3] for r in want])
