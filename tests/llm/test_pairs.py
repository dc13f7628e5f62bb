"""Rare-first Jaccard join, tokenizer alignment and hard negatives."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from fieldstat.llm import alignment, hard_negatives, members, ngram_join, packed, perfect_hash, queries
from fieldstat.llm.tokens import vocabulary_path

from . import brute
from .conftest import SCHEMA, as_lists, edge_texts, rows_of


def jaccard(docs, size=5, percent=80):
    """doc_id, set size, component_id of every row."""
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    group = list(range(len(docs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                group[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(docs):
        ids.setdefault(find(i), []).append(d)
    least = {g: min((d for d in ds if d is not None), default=None) for g, ds in ids.items()}
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(docs)]


def near_copies(rng, n, words, changes):
    text = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(text)
        for _ in range(rng.randrange(changes)):
            copy[rng.randrange(words)] = f"v{rng.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


def shared_passages():
    """Near copies of many degrees, documents made of common passages, and common words around them."""
    rng = random.Random(5)
    texts = [x for words, changes in ((30, 3), (60, 5), (120, 12), (400, 30), (7, 2)) for x in near_copies(rng, 25, words, changes)]
    passages = near_copies(rng, 12, 15, 1) + [" ".join(f"p{i}-{k}" for k in range(12)) for i in range(12)]
    texts += [" ".join(rng.choice(passages) for _ in range(rng.randrange(1, 8))) for _ in range(80)]
    texts += ["be " * k for k in range(8)] + texts[:10] + ["", None, "Word", "word", "A b c d", "a B c D", "a b c d e"]
    return list(enumerate(texts))


def test_join_on_edges(edges):
    got = as_lists(ngram_join.similar(edges), "doc_id", "n_shingles", "component_id")
    assert got == sorted(jaccard(edge_texts()), key=repr)


@pytest.mark.parametrize("size,percent", [(5, 80), (3, 60), (1, 95)])
def test_join_of_shared_passages(spark, size, percent):
    docs = shared_passages()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = as_lists(ngram_join.similar(df, size, percent), "doc_id", "n_shingles", "component_id")
    assert got == sorted(jaccard(docs, size, percent), key=repr)


def test_join_by_blocks_chunks_and_equal_fingerprints(spark, monkeypatch):
    """Small chunks, cells and batches, and fingerprints so short that different n-grams share them."""
    for name, value in (("ROUND", 200), ("PER_OWNER", 300), ("CELL", 4), ("ROWS", 64), ("LEAD", 100), ("PAIRS", 50), ("SLACK_BITS", 0)):
        monkeypatch.setattr(ngram_join, name, value)
    docs = shared_passages()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = as_lists(ngram_join.similar(df), "doc_id", "n_shingles", "component_id")
    assert got == sorted(jaccard(docs), key=repr)


def test_join_hands_few_rows_to_python_at_a_time(spark, monkeypatch):
    """Batches are bounded while the join's own jobs run, and the session's setting is as before afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, keep = spark.conf.get(key), [], ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda *a: seen.append(int(spark.conf.get(key))) or keep(*a))
    df = spark.createDataFrame(shared_passages(), "doc_id long, text string")
    ngram_join.similar(df).count()
    assert seen and max(seen) <= ngram_join.BATCH
    assert spark.conf.get(key) == before


def test_join_of_a_hot_group_lists_few_pairs(spark, monkeypatch):
    """Near copies of one text are a third of all rows: candidate pairs grow with the group, not with its square."""
    rng = random.Random(3)
    copies = near_copies(rng, 600, 200, 4)
    others = [" ".join(f"o{i}-{k}" for k in range(40)) for i in range(1200)]
    df = spark.createDataFrame(list(enumerate(copies + others)), "doc_id long, text string").repartition(8)
    sizes, keep = [], ngram_join.stored

    def counted(frame, name):
        out = keep(frame, name)
        if name == "pairs":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    found = ngram_join.similar(df)
    assert found.groupBy("component_id").count().where("count > 1").collect()[0]["count"] == 600
    assert sum(sizes) < 6000  # of 179,700


def test_join_shuffles_whole_rows_only_of_unsettled_grams(spark, monkeypatch):
    rng = random.Random(17)
    rows = list(enumerate(text for _ in range(12) for text in near_copies(rng, 9, 120, 3)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    whole, passes, keep_attach, keep_stored = [], [], ngram_join.attach, ngram_join.stored

    def attached(some, *a):
        if "after" in some.columns:
            whole.append((len(passes), some.count()))
        return keep_attach(some, *a)

    def stored(some, name):
        if name == "labels":
            passes.append(name)
        return keep_stored(some, name)

    monkeypatch.setattr(ngram_join, "attach", attached)
    monkeypatch.setattr(ngram_join, "stored", stored)
    got = as_lists(ngram_join.similar(df), "doc_id", "n_shingles", "component_id")
    assert got == sorted(jaccard(rows), key=repr)
    first, later = [n for p, n in whole if p == 0], [n for p, n in whole if p == 1]
    assert first and later and 4 * max(later) < max(first)  # near copies are connected by the first pass


def test_join_shuffles_a_text_once_for_its_set(spark, monkeypatch, capsys):
    rng = random.Random(18)
    df = spark.createDataFrame(list(enumerate(near_copies(rng, 6, 120, 3))) * 2, "doc_id long, text string").repartition(3)
    plans, keep = [], ngram_join.stored

    def stored(some, name):
        if name == "sets":
            capsys.readouterr()
            some.explain()
            plans.append(capsys.readouterr().out)
        return keep(some, name)

    monkeypatch.setattr(ngram_join, "stored", stored)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ngram_join.similar(df).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 1 and plans[0].count("Exchange hashpartitioning") == 2  # the texts, and the list of those wanted


def test_join_equals_its_sql_and_ignores_other_columns(spark, no_docs):
    assert ngram_join.similar(no_docs).count() == 0
    rows = spark.createDataFrame(rows_of([(1, "a b c d e f"), (2, "A b c d e f"), (2, "A b c d e f")]), SCHEMA)
    assert as_lists(ngram_join.similar(rows), "doc_id", "n_shingles", "component_id", "component_size") == [
        (1, 2, 1, 3), (2, 2, 1, 3), (2, 2, 1, 3)]


@pytest.mark.parametrize("values", [[], [0], [5, 5, 7], [2 ** 63, 1, 2 ** 64 - 1], list(range(0, 10 ** 6, 37))])
def test_packed_round_trip(values):
    assert packed.unpack(packed.pack(np.array(values, np.uint64))).tolist() == values
    short = [v % (1 << 32) for v in reversed(values)]
    assert packed.unpack_unordered(packed.pack_unordered(np.array(short, np.int64))).tolist() == short


def test_membership_filter_never_drops_a_key(spark):
    keys = spark.range(0, 40_000, 7).select(F.xxhash64("id").alias("h"))
    rows = spark.range(40_000).select("id", F.xxhash64("id").alias("h"))
    passed = {r.id for r in rows.where(members.may_be_in(F.col("h"), keys)).collect()}
    assert set(range(0, 40_000, 7)) <= passed and len(passed) < 40_000 / 7 * 1.3
    assert rows.where(members.may_be_in(F.col("h"), keys.where("false"))).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 100_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64)) if n > 2 else np.arange(n, dtype=np.uint64)
    table = perfect_hash.PerfectHash.load(perfect_hash.PerfectHash.build(keys).dump())
    assert sorted(table.numbers(keys).tolist()) == list(range(len(keys)))
    other = table.numbers(keys + np.uint64(1))
    assert ((other >= -1) & (other < max(1, len(keys)))).all()


PATHS = vocabulary_path("byte_bpe_50k.tiktoken"), vocabulary_path("piece_bpe_32k.model")


def plain_alignment(docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    v = alignment.vocabularies(*PATHS)
    return brute.alignments(docs, lambda x: [(i, v.bytes_a[i]) for i in t.encode(x, add_special_tokens=False).ids],
                            lambda x: [(i, v.bytes_b[i]) for i in v.model.encode(x)])


def aligned(df):
    columns = "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"
    return sorted(((*r[:7], r[7].decode()) for r in alignment.align(df, *PATHS).select(*columns).collect()), key=repr)


ODD = ["a▁b plain", "▁", "  two  blanks ", "\n\nx \ty\n", "end ", " start", "tab\tin  nbsp x　y", "ﬁ Å é",
       "<s> </s> <unk> <|endoftext|> <0x41>", "x\x00y \x7f", "=" * 5000, "日本語 " * 50, "🙂🙂 👩‍👩‍👧", "don't I'll we've 3.14",
       "ͅa ᾀ", "a" * 3000 + " b", " ", "\t", "￿ \U0010ffff"]


def test_alignment_on_edges(spark, edges, no_docs):
    assert aligned(edges) == sorted(plain_alignment(edge_texts()), key=repr)
    assert alignment.align(no_docs, *PATHS).count() == 0


def test_alignment_of_odd_texts_in_small_chunks(spark, monkeypatch):
    for name, value in (("CHUNK", 300), ("JOINED", 40), ("SHARDS", 5), ("FAN", 2), ("GROUP", 3)):
        monkeypatch.setattr(alignment, name, value)
    docs = [(i, t) for i, t in enumerate(ODD * 2 + ["the cat sat on the mat", "The cat, the mat."] * 20 + [None, ""])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert aligned(df) == sorted(plain_alignment(docs), key=repr)


def test_texts_are_cut_where_both_tokenizers_cut():
    v = alignment.vocabularies(*PATHS)
    rng = random.Random(1)
    marks = ["a", "B", "é", " ", " ", "  ", "\n", "\t", ".", "'s", "1", " ", "　", "日", "🙂", "​", "\x1c", "\x85", "-"]
    for _ in range(3000):
        text = "".join(rng.choice(marks) for _ in range(rng.randrange(1, 14)))
        words = alignment.pieces(text)
        assert " ".join(words) == text
        a, n_a, b, n_b, right = alignment.encode(words, v)
        if right.all():
            assert a.tolist() == v.encode_a(" " + text) and b.tolist() == v.model.encode(text)
        assert right.all() == (b"".join(v.bytes_b[i] for i in v.model.encode(text)) == (" " + text).encode())


def test_alignment_query_equals_a_plain_version(spark, sf, sf_docs):
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[3] else "") for r in plain_alignment(sf_docs)]
    got = queries.op12_hashed_alignment(spark, sf)
    assert as_lists(got, "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256") == sorted(want, key=repr)


def plain_negatives(rows, anchors, positives=5, negatives=10, low=30, high=90, scale=256):
    def read(rows):
        for i, v, label in rows:
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
                x = [math.floor(scale * c) for c in v]
                if sum(c * c for c in x) <= 1 << 60:
                    yield i, x, label

    rows, out = list(read(rows)), []
    for i, q, label in read(anchors):
        scored = sorted(((-sum(a * b for a, b in zip(q, x)), j, other) for j, x, other in rows if len(x) == len(q) and j != i),
                        key=lambda r: r[:2])
        for p, pid, _ in [r for r in scored if r[2] == label][:positives]:
            fit = [(j, -s) for s, j, other in scored if other != label and low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(i, pid, k, j, -p, s) for k, (j, s) in enumerate(fit, 1)]
    return sorted(out)


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("label", T.IntegerType()), T.StructField("score", T.StringType()), T.StructField("anchor", T.StringType())])


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(4)


def test_negatives_on_edges(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * rng.choice([0.1, 1, 20]) for _ in range(6)], i % 3) for i in range(150)]
    rows += [(None, [1.0] * 6, 1), (200, None, 1), (201, [1.0] * 6, None), (202, [1.0, None] * 3, 1), (203, [float("nan")] + [1.0] * 5, 1),
             (204, [float("inf")] * 6, 2), (205, [1e300] * 6, 2), (206, [1e6] * 6, 1), (207, [], 1), (208, [], 2), (209, [0.0] * 6, 1),
             (210, [1.0, 2.0], 1), (211, [1.0, 2.0], 1), (212, [1.0, 1.0], 2), (5, [1.0] * 6, 2), (7, [2.0] * 6, 1), (7, [2.0] * 6, 1),
             (300, [-1.0] * 6, 1), (301, [-1.0] * 6, 1), (302, [0.25] * 6, 2), (303, [0.25] * 6, 2)]
    df = vectors_of(spark, rows)
    assert as_lists(hard_negatives.mine(df, df.where("vec_id % 5 = 0 OR vec_id > 200")), "anchor_id", "positive_id", "rank",
                    "negative_id", "positive_score", "negative_score") == sorted(
        plain_negatives(rows, [r for r in rows if r[0] is not None and (r[0] % 5 == 0 or r[0] > 200)]), key=repr)
    assert hard_negatives.mine(df.where("false"), df).count() == 0
    assert hard_negatives.mine(df, df.where("false")).count() == 0


def test_negatives_in_small_buckets_and_cells(spark, monkeypatch):
    for name, value in (("BUCKET", 8), ("HELD", 24), ("ANCHORS", 5)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)], rng.choice([0, 0, 0, 1, 2])) for i in range(400)]
    df = vectors_of(spark, rows)
    got = hard_negatives.mine(df, df.where("vec_id % 10 = 0"), positives=3, negatives=4, low=50, high=95, scale=1000)
    want = plain_negatives(rows, [r for r in rows if r[0] % 10 == 0], 3, 4, 50, 95, 1000)
    assert as_lists(got, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") == sorted(want, key=repr)


def test_coordinate_ranges_prune_and_keep(spark):
    """Candidates hold every row above the threshold, and far fewer than all rows when it is high."""
    rng = np.random.default_rng(0)
    vectors = np.rint(rng.normal(size=(2000, 8)) * 100).astype(np.int32)
    bucket = hard_negatives._Bucket({"ids": np.arange(2000).tobytes(), "labels": np.zeros(2000, np.int64).tobytes(), "n": 2000, "dim": 8,
                                     "vectors": vectors.tobytes(), "longest": float(np.sqrt((vectors.astype(float) ** 2).sum(1)).max())})
    for q in vectors[:20].astype(np.int64):
        scores, length = vectors.astype(np.int64) @ q, float(np.sqrt((q * q).sum()))
        unit = q / length
        focus = np.argsort(-np.abs(unit))[:4].tolist()
        for least in np.sort(scores)[[-1, -5, -50, -1000]]:
            kept = bucket.candidates(unit, length, focus, float(least))
            assert set(np.flatnonzero(scores >= least)) <= set(kept.tolist()) or least <= 0
    assert len(bucket.candidates(unit, length, focus, length * bucket.longest * 0.95)) < 200
    assert len(bucket.candidates(unit, length, focus, length * bucket.longest * 1.01)) == 0


def test_negatives_query(spark, sf):
    rows = [(r.vec_id, list(r.embedding), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op13_lemp_negatives(spark, sf)
    assert as_lists(got, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") == sorted(
        plain_negatives(rows, [r for r in rows if r[0] % 100 == 0]), key=repr)
