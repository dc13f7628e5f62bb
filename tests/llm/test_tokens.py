import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldstat.llm import chunk_bpe, length_histogram, packing, queries
from fieldstat.llm.tokens import encoder, tokenizer, vocabulary_path

from .conftest import as_lists, edge_texts

WORD, BYTE = (vocabulary_path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))


def library_ids(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


def pack_ids(ids):
    return np.array(ids, "<u4").tobytes()


def test_chunked_ids_equal_the_library_on_edges(edges):
    got = {(r.doc_id, bytes(r.ids), r.decoded) for r in chunk_bpe.encode_decode(edges, WORD).collect()}
    want = set()
    for d, t in edge_texts():
        ids = library_ids(WORD, t)
        want.add((d, pack_ids(ids), tokenizer(WORD).decode(ids, skip_special_tokens=False)))
    assert got == want


@pytest.mark.parametrize("bits", [2, 4, 11])
def test_chunks_cut_anywhere_give_the_same_ids(monkeypatch, bits):
    """Small chunks, cuts inside words: joins are repaired."""
    monkeypatch.setattr(chunk_bpe, "REACH", 2)
    monkeypatch.setattr(chunk_bpe.cuts, "__defaults__", (bits,))
    rng = random.Random(bits)
    coder = chunk_bpe.ChunkCoder(WORD)
    pieces = ["don't", "it's", "ΟΔΟΣ", "e", "́", " ", "  \n", " ", "日本", "x9", "<|endoftext|>", "!!", "we'll", "\x1c", "İ"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(300))) for _ in range(60)]
    assert coder.encode([t.encode() for t in texts]) == [pack_ids(library_ids(WORD, t)) for t in texts]


def test_cuts_follow_content():
    rng = random.Random(1)
    shared = " ".join(str(rng.random()) for _ in range(2000)).encode()
    a, b = (chunk_bpe.cuts(head + shared, 8) for head in (b"", b"other start of another length "))
    shift = len("other start of another length ")
    assert len(a) > 20 and len(set(a) & {x - shift for x in b}) >= len(a) - 2


def test_shared_chunks_are_encoded_once():
    rng = random.Random(2)
    text = " ".join(str(rng.random()) for _ in range(3000)).encode()
    coder, calls = chunk_bpe.ChunkCoder(WORD), []
    library = coder._library
    coder._library = lambda pieces: calls.append(sum(map(len, pieces))) or library(pieces)
    coder.encode([text])
    first = sum(calls)
    coder.encode([text + b" more", text])
    assert sum(calls) - first < first / 20


def test_tokenizers_that_keep_space_are_refused():
    with pytest.raises(ValueError, match="white space"):
        chunk_bpe.ChunkCoder(BYTE)


def test_rank_file_gives_the_librarys_ids():
    encode = encoder(BYTE)
    assert all(encode(t or "") == library_ids(BYTE, t) for _, t in edge_texts())


def test_rank_file_on_many_code_points():
    encode = encoder(BYTE)
    points = [chr(c) for c in (*range(0x3400), *range(0x3400, 0x110000, 37)) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50_000):
        text = "".join(f"{c}a{c} 1{c}{c}.  {c}" for c in points[at:at + 50_000])
        assert encode(text) == library_ids(BYTE, text), at


def test_very_long_white_space():
    """tiktoken gives up on such runs."""
    encode, ranks = encoder(BYTE), encoder(BYTE.removesuffix(".json") + ".tiktoken")
    for text in (" " * 2_000_000, "a" + "\n" * 1_200_000 + "b", "x  " + "\t \u3000" * 700_000 + " y " + " " * 1_000_000 + "z  "):
        want = library_ids(BYTE, text)
        assert encode(text) == want and ranks(text) == want


def test_histogram_on_edges(edges):
    lengths = np.array([len(library_ids(BYTE, t)) for _, t in edge_texts()])
    rows = length_histogram.limits_of(edges, BYTE).collect()
    assert sorted(r.context_limit for r in rows) == sorted(set(lengths.tolist()))
    for r in rows:
        cut = np.minimum(lengths, r.context_limit)
        assert (r.truncated_total, r.docs_over, r.total_tokens) == (cut.sum(), (lengths > r.context_limit).sum(), lengths.sum())
        assert r.docs_within + r.docs_over == len(lengths) and r.tokens_over == lengths[lengths > r.context_limit].sum()
        assert r.quantile == pytest.approx((lengths <= r.context_limit).mean())


def test_histogram_blocks_and_quantiles(spark, monkeypatch):
    monkeypatch.setattr(length_histogram, "BLOCK", 3)
    counts = spark.createDataFrame([(n, n % 4 + 1) for n in range(0, 40, 3)], "length long, n_docs long")
    lengths = np.repeat(np.arange(0, 40, 3), [n % 4 + 1 for n in range(0, 40, 3)])
    limits = length_histogram.context_limits(counts)
    for r in limits.collect():
        assert r.truncated_total == np.minimum(lengths, r.context_limit).sum()
    found = {r.share: r.length for r in length_histogram.quantiles(limits, [0.0, 0.5, 0.9, 1.0]).collect()}
    assert found == {s: int(np.quantile(lengths, s, method="inverted_cdf")) for s in found}


def test_given_limits_and_shares(spark):
    counts = spark.createDataFrame([(n, n % 4 + 1) for n in range(6, 40, 3)], "length long, n_docs long")
    lengths = np.repeat(np.arange(6, 40, 3), [n % 4 + 1 for n in range(6, 40, 3)])
    limits = length_histogram.context_limits(counts)
    rows = limits.unionByName(length_histogram.at_limits(limits, [0, 5, 6, 10, 10, 38, 1024])).collect()
    assert sorted(r.context_limit for r in rows) == sorted({*lengths.tolist(), 0, 5, 10, 38, 1024})
    for r in rows:
        over = lengths > r.context_limit
        assert (r.n_docs, r.docs_over, r.docs_within) == ((lengths == r.context_limit).sum(), over.sum(), (~over).sum())
        assert (r.tokens_over, r.truncated_total) == (lengths[over].sum(), np.minimum(lengths, r.context_limit).sum())
        assert r.total_tokens == lengths.sum() and r.quantile == pytest.approx((~over).mean())
    shares = [0.1, 0.5, 0.9, 1.0]
    found = {s: r.context_limit for r in length_histogram.with_shares(limits, shares).collect() for s in r.shares}
    assert found == {r.share: r.length for r in length_histogram.quantiles(limits, shares).collect()}
    assert length_histogram.at_limits(limits.limit(0), [1, 2]).count() == 0


def test_fullest_combination_is_optimal():
    rng = random.Random(9)
    for _ in range(200):
        room = rng.randrange(1, 40)
        counts = [0] + [rng.choice([0, 0, 1, 2, 5]) for _ in range(room)]
        sums = {0}
        for length, n in enumerate(counts):
            for _ in range(n if length else 0):
                sums |= {s + length for s in sums if s + length <= room}
        chosen = packing.fullest(counts, room)
        assert sum(chosen) == max(sums) and all(chosen.count(x) <= counts[x] for x in chosen)


def check_packing(rows, docs, capacity):
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.piece), []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    for pieces in by_bin.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    want = []
    for d, t in docs:
        ids = library_ids(BYTE, t) + [2]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(d, i, a, b - a, zlib.crc32(pack_ids(ids[a:b]))) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(want, key=repr) == sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr)
    return len(by_bin), sum(x[3] for x in want)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing_on_edges(edges, capacity):
    check_packing(packing.pack_documents(edges, BYTE, capacity).collect(), edge_texts(), capacity)


def test_packing_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 300)
    rng = random.Random(4)
    rows = [(i, min(1024, 1 + int(rng.expovariate(1 / 300)))) for i in range(3000)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, length long"), ["doc_id"]).collect()
    bins = len({r.sequence_id for r in packed})
    assert len(packed) == 3000 and bins <= sum(n for _, n in rows) / 1024 + 2 * 10 + 10
    same = packing.pack(spark.createDataFrame([(None, 100)] * 3000, "doc_id long, length long"), ["doc_id"]).collect()
    by_group = Counter(r.sequence_id >> 32 for r in same)
    assert len(same) == 3000 and len(by_group) == 10 and max(by_group.values()) < 450
    assert len({r.sequence_id for r in same}) == sum(-(-n // 10) for n in by_group.values())


def test_queries(spark, sf, sf_docs):
    n, total = check_packing(queries.op8_min_bin_slack(spark, sf).collect(), sf_docs, 1024)
    assert n <= total / 1024 * 1.02 + 3
    rows = queries.op3_chunk_reuse_bpe(spark, sf)
    want = []
    for d, t in sf_docs:
        ids = library_ids(WORD, t)
        decoded = tokenizer(WORD).decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(pack_ids(ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert as_lists(rows, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    lengths = [len(library_ids(BYTE, t)) for _, t in sf_docs]
    limits = queries.op6_length_histogram(spark, sf)
    assert limits.agg(F.sum("n_docs")).first()[0] == len(lengths)
    assert limits.select(F.max("total_tokens")).first()[0] == sum(lengths)


def test_empty_tables(no_docs):
    assert chunk_bpe.encode_decode(no_docs, WORD).count() == 0
    assert length_histogram.limits_of(no_docs, BYTE).count() == 0
    assert packing.pack_documents(no_docs, BYTE).count() == 0


def test_length_query_equals_a_count_of_every_column(spark, sf, sf_docs):
    """All rows and columns of the query, from the library's lengths."""
    lengths = [len(library_ids(BYTE, t)) for _, t in sf_docs]
    n, asked = len(lengths), [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]
    smallest = {s: min(v for v in set(lengths) if sum(x <= v for x in lengths) / n >= s) for s in asked}
    rows = queries.op6_length_histogram(spark, sf).collect()
    assert sorted(r.context_limit for r in rows) == sorted(set(lengths) | {1 << k for k in range(18)})
    for r in rows:
        v = r.context_limit
        over = [x for x in lengths if x > v]
        assert (r.n_docs, r.docs_within, r.docs_over, r.tokens_over) == (lengths.count(v), n - len(over), len(over), sum(over))
        assert (r.truncated_total, r.total_tokens) == (sum(min(x, v) for x in lengths), sum(lengths))
        assert r.quantile == (n - len(over)) / n and r.shares == [s for s in asked if smallest[s] == v]
