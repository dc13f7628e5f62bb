"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (alignment, block_ann, chunk_bpe, exact_dedup, hard_negatives, length_histogram, ngram_join, packing,
               quality, secret_scan, simhash, substring_dedup, warc)
from .common import documents
from .tokens import vocabulary_path


def op1_chunked_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a WARC record per page, read the archives back."""
    found = warc.read_archives(warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated 13-word windows removed."""
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir), window=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded."""
    coded = chunk_bpe.encode_decode(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_golomb_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts."""
    return exact_dedup.decisions(documents(spark, sf_dir))


def op5_pigeonring_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and their components."""
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=4, distance=4)


def op6_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by encoded length, and what every context limit keeps; usual limits and quantiles among them."""
    limits = length_histogram.limits_of(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"))
    limits = limits.unionByName(length_histogram.at_limits(limits, [1 << k for k in range(18)]))
    return length_histogram.with_shares(limits, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0])


def op7_secret_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in texts and in what texts encode."""
    found = secret_scan.scan(documents(spark, sf_dir))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
                        "spans", "fully_scanned")


def op8_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 1024 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op9_block_matrix_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every vector whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return block_ann.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op10_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op11_rare_first_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by a Jaccard similarity of 0.8 or more of their five-word shingles."""
    return ngram_join.similar(documents(spark, sf_dir), size=5, percent=80)


def op12_hashed_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level tokens aligned with pieces, with corpus counts of aligned id pairs."""
    found = alignment.align(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.tiktoken"),
                            vocabulary_path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return found.withColumn("groups_sha256", digest).drop("groups")


def op13_lemp_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor whose id is divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("label", label)
    return hard_negatives.mine(vectors, vectors.filter(F.col("vec_id") % 100 == 0), positives=5, negatives=10, low=30, high=90,
                               scale=256)


QUERIES = {f.__name__: f for f in (
    op1_chunked_warc, op2_substring_dedup, op3_chunk_reuse_bpe, op4_golomb_exact_dedup, op5_pigeonring_simhash,
    op6_length_histogram, op7_secret_worklist, op8_min_bin_slack, op9_block_matrix_ann, op10_mil_quality, op11_rare_first_jaccard,
    op12_hashed_alignment, op13_lemp_negatives)}

SQL = {
    "op1_chunked_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
        ), d AS (
            SELECT page_id, octet_length(body) AS size, sha1(body) AS digest, sha256(body) AS strong FROM p
        ), r AS (
            SELECT *, CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY strong, size) ELSE page_id END AS largest FROM d
        )
        SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> largest THEN largest END AS refers_to
        FROM r""",
    "op2_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ), p AS (
            SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d
        ), w AS (
            SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS seq FROM p
        ), f AS (
            SELECT doc_id, i, min(doc_id) OVER (PARTITION BY seq) AS first FROM w
        ), c AS (
            SELECT DISTINCT doc_id, i + k AS word_no FROM f, range(0, 13) AS t(k) WHERE first < doc_id
        ), g AS (
            SELECT doc_id, list(word_no) AS gone FROM c GROUP BY doc_id
        ), e AS (
            SELECT d.doc_id, words, coalesce(gone, []) AS gone FROM d LEFT JOIN g USING (doc_id)
        ), k AS (
            SELECT e.doc_id, len(words) AS n_words, len(gone) AS n_removed,
                   array_to_string(list_filter(words, lambda x, i: NOT list_contains(gone, i)), ' ') AS kept
            FROM e
        )
        SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(kept) AS kept_sha256 FROM k""",
    "op4_golomb_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
        ), g AS (
            SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS n FROM t
        )
        SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g""",
    "op11_rare_first_jaccard": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, row_number() OVER () AS n, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda x: x <> '') AS words
            FROM documents
        ), p AS (
            SELECT n, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS i FROM d
        ), g AS (
            SELECT DISTINCT n, array_to_string(words[i:i + 4], ' ') AS gram FROM p
        ), s AS (
            SELECT n, count(*) AS size FROM g GROUP BY n
        ), o AS (
            SELECT a.n AS u, b.n AS v, count(*) AS common FROM g AS a JOIN g AS b ON a.gram = b.gram AND a.n <> b.n GROUP BY a.n, b.n
        ), l AS (
            SELECT u, v FROM o JOIN s AS x ON x.n = u JOIN s AS y ON y.n = v WHERE 100 * common >= 80 * (x.size + y.size - common)
        ), r(u, v) AS (
            SELECT n, n FROM d UNION SELECT r.u, l.v FROM r JOIN l ON l.u = r.v
        ), c AS (
            SELECT r.u, min(d.doc_id) AS component_id, count(*) AS component_size FROM r JOIN d ON d.n = r.v GROUP BY r.u
        )
        SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id, component_size::BIGINT AS component_size
        FROM d JOIN c ON c.u = d.n LEFT JOIN s ON s.n = d.n""",
    "op13_lemp_negatives": r"""
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   list_sum(list_transform(list_zip(a.v, b.v), lambda t: t[1] * t[2]))::BIGINT AS score
            FROM e AS a JOIN e AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        ), n AS (
            SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
            FROM p JOIN s USING (anchor_id)
            WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        )
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
