import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldstat.llm import components, exact_dedup, golomb, members, queries, simhash, substring_dedup

from . import brute
from .conftest import SCHEMA, as_lists, edge_texts, rows_of


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (1, 1 << 40), (5, 5), (1000, 1 << 20), (3000, 1 << 45)])
def test_golomb_round_trip(n, universe):
    values = np.array(sorted(random.Random(n).sample(range(universe), n)), np.uint64)
    code = golomb.encode(values, universe)
    assert np.array_equal(golomb.decode(code), values)
    if n >= 1000:
        assert len(code) * 8 < n * (np.log2(universe / n) + 3) + 200  # near the information bound


def test_exact_decisions_on_edges(edges):
    got = as_lists(exact_dedup.decisions(edges), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(brute.equal_texts(edge_texts()), key=repr)


def test_exact_with_many_false_suspects(spark, monkeypatch):
    """With few fingerprint bits most rows are suspects; the byte comparison decides."""
    monkeypatch.setattr(exact_dedup, "SLACK_BITS", 0)
    docs = [(i, f"text {i // 2 if i % 3 == 0 else i}") for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = as_lists(exact_dedup.decisions(df), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(brute.equal_texts(docs), key=repr)


def test_exact_with_a_full_filter(spark, edges, monkeypatch):
    """A filter too small for its keys lets rows pass and drops none."""
    monkeypatch.setattr(members, "LARGEST", 8)
    monkeypatch.setattr(exact_dedup, "ROUND", 4)
    got = as_lists(exact_dedup.decisions(edges), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(brute.equal_texts(edge_texts()), key=repr)


def test_exact_deduplicate_keeps_rows(edges):
    kept = exact_dedup.deduplicate(edges)
    assert kept.columns == edges.columns
    best = {}
    for d, _, _, _, sha in brute.equal_texts(edge_texts()):
        best[sha] = min(best.get(sha, (True, 0)), (d is None, d or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(best.values())


def test_hot_copies(spark):
    """One text is a third of all rows."""
    docs = [(i, "hot text" if i % 3 == 0 else f"own {i}") for i in range(6000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    sizes = exact_dedup.decisions(df).groupBy("group_size").count().collect()
    assert {r.group_size: r["count"] for r in sizes} == {2000: 2000, 1: 4000}
    near = simhash.near_duplicates(df.filter("doc_id % 3 = 0"))
    assert near.select("component_id").distinct().collect()[0][0] == 0


@pytest.mark.parametrize("operator", [exact_dedup.decisions, exact_dedup.deduplicate, simhash.near_duplicates,
                                      simhash.deduplicate, substring_dedup.remove_repeats])
def test_empty_tables(no_docs, operator):
    assert operator(no_docs).count() == 0


def test_substring_on_edges(edges):
    got = substring_dedup.remove_repeats(edges).withColumn("sha", F.sha2("kept", 256))
    assert as_lists(got, "doc_id", "n_words", "n_removed", "sha") == sorted(brute.repeats_removed(edge_texts()), key=repr)


@pytest.mark.parametrize("runs", [2, 2000])
def test_substring_common_passage(spark, monkeypatch, runs):
    """A passage in very many contexts (beyond RUNS: compared window by window), and overlaps of many lengths."""
    monkeypatch.setattr(substring_dedup, "RUNS", runs)
    monkeypatch.setattr(substring_dedup, "SHARD", 50)
    monkeypatch.setattr(substring_dedup, "ROUND", 2000)
    rng = random.Random(3)
    say = lambda n: [rng.choice("abcdefghij") + str(rng.randrange(6)) for _ in range(n)]
    passage = say(30)
    docs = []
    for i in rng.sample(range(1000), 120):
        a, b = sorted((rng.randrange(31), rng.randrange(31)))
        docs.append((i, " ".join(say(rng.randrange(20)) + passage[a:b] + say(rng.randrange(20)))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = substring_dedup.remove_repeats(df).withColumn("sha", F.sha2("kept", 256))
    assert as_lists(got, "doc_id", "n_words", "n_removed", "sha") == sorted(brute.repeats_removed(docs), key=repr)


def test_automaton_labels():
    rng = random.Random(5)
    automaton, seen = substring_dedup._Automaton(), []
    for label in range(60):
        words = [rng.choice("ab") for _ in range(rng.randrange(3, 14))]
        for size in (3, 4):
            want = [next((k for k, w in enumerate(seen) if any(w[j:j + size] == words[i:i + size] for j in range(len(w)))),
                         None) for i in range(len(words) - size + 1)]
            assert automaton.windows(words, size) == want
        automaton.add(words, label)
        seen.append(words)


def test_near_groups_on_edges(edges):
    got = as_lists(simhash.near_duplicates(edges), "doc_id", "fingerprint", "component_id")
    assert got == sorted(brute.near_groups(edge_texts()), key=repr)


@pytest.mark.parametrize("cell,pairs", [(4096, 1 << 21), (7, 5)])
@pytest.mark.parametrize("distance", [1, 3, 4])
def test_links_of_close_fingerprints(spark, monkeypatch, cell, pairs, distance):
    """Dense clusters, split into blocks, against all pairs."""
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    rng = random.Random(distance)
    prints = set()
    for _ in range(12):
        p = rng.getrandbits(64)
        for _ in range(15):
            prints.add(p)
            for _ in range(rng.randrange(1, distance + 2)):
                p ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3), distance)
    labels = {r.node: r.component for r in components.components(links).collect()}
    group = list(range(len(prints)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                group[find(i)] = find(j)
    want, got = {}, {}
    for i, s in enumerate(signed):
        want.setdefault(find(i), set()).add(s)
        got.setdefault(labels.get(s, s), set()).add(s)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 100)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 200)}


def test_simhash_deduplicate(edges):
    kept = simhash.deduplicate(edges)
    assert kept.columns == edges.columns
    got = sorted({(r.doc_id is None, r.doc_id) for r in kept.collect()}, key=repr)
    want = {c: min((d is None, d) for d, _, x in brute.near_groups(edge_texts()) if x == c and (d is not None or c is None))
            for _, _, c in brute.near_groups(edge_texts())}
    assert got == sorted(set(want.values()), key=repr)


def test_queries_against_brute_force(spark, sf, sf_docs):
    near = queries.op5_pigeonring_simhash(spark, sf)
    assert as_lists(near, "doc_id", "fingerprint", "component_id") == sorted(brute.near_groups(sf_docs), key=repr)
    sub = queries.op2_substring_dedup(spark, sf)
    assert as_lists(sub, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.repeats_removed(sf_docs), key=repr)
    exact = queries.op4_golomb_exact_dedup(spark, sf)
    assert as_lists(exact, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(
        brute.equal_texts(sf_docs), key=repr)


def test_clashing_rows_helper():
    assert len(rows_of([(1, "a")])[0]) == len(SCHEMA)


def test_columns_of_any_name_come_back_as_they_were(edges):
    """Names that the operators use inside, in any case, are carried unchanged."""
    from fieldstat.llm import packing
    values = {c: F.concat(F.lit(f"mine {c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
              for c in SCHEMA.names if c not in ("doc_id", "text", "n_chars")}
    docs = edges.withColumns(values)
    for kept in (exact_dedup.deduplicate(docs), simhash.deduplicate(docs)):
        assert kept.columns == docs.columns
        for row in kept.collect():
            assert all(row[c] == f"mine {c} {'none' if row.doc_id is None else row.doc_id}" for c in values)
    rows = docs.withColumn("length", F.lit(5))
    packed = packing.pack(rows, ["doc_id"], 12)
    assert packed.columns == [*rows.columns, "sequence_id", "offset"]
    for row in packed.collect():
        assert all(row[c] == f"mine {c} {'none' if row.doc_id is None else row.doc_id}" for c in values if c != "length")


def test_places_are_one_row_per_document_whatever_the_owners(spark, monkeypatch):
    """A document's places lie with many owners; their answers meet before they become rows."""
    monkeypatch.setattr(substring_dedup, "PER_OWNER", 500)
    rng = random.Random(11)
    passages = [" ".join(f"p{k}-{rng.randrange(9)}" for _ in range(40)) for k in range(8)]
    docs = [(i, " ".join(rng.sample(passages, 4))) for i in range(60)] + [(3, passages[0] + " " + passages[1])] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = df.select("doc_id", F.col("text").cast("binary").alias("body")).withColumn("key", F.xxhash64("doc_id", "body"))
    places = substring_dedup.repeated_places(rows, 13, substring_dedup.ANCHOR)
    assert 0 < places.count() <= len(docs)
    got = substring_dedup.remove_repeats(df).withColumn("sha", F.sha2("kept", 256))
    assert as_lists(got, "doc_id", "n_words", "n_removed", "sha") == sorted(brute.repeats_removed(docs), key=repr)
