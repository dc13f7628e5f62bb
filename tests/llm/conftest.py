import random

import pytest
from pyspark.sql import functions as F, types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    *[T.StructField(c, T.StringType()) for c in (
        "fp", "key", "score", "kept", "h", "length", "size", "body", "th", "component", "first", "held_out", "ids",
        "piece", "start", "spans", "label", "run", "words", "anchor", "keep_id", "group_size",
        "__text", "__fp", "__suspect", "__row", "__id", "__th", "__heavy", "__group", "row", "suspect", "group", "heavy", "id",
        "Heavy_")]])


def rows_of(pairs):
    extra = [None if i % 2 else "x" for i in range(len(SCHEMA) - 5)]
    return [(d, t, "en", None, None if t is None else len(t), *extra) for d, t in pairs]


def edge_texts():
    """(doc_id, text): nulls, empty, white space, ties, repeated rows, very long ones, odd characters."""
    rng = random.Random(7)
    words = ["the", "of", "Énd", "tion", "ing", "über", "don't", "x1", "3.14", "ñandú", "—", "ΟΔΟΣ", "éa", "日本語"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, long = say(40), say(20_000)
    return [
        (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "one"), (5, "one"), (6, " one"), (7, "two  words"), (8, "two\nwords"),
        (9, passage), (10, passage + " " + say(30)), (11, say(20) + "\n" + passage), (11, say(20) + "\t" + passage),
        (12, passage), (12, passage), (13, "be " * 60), (14, "be " * 61), (15, long), (16, long + " tail"),
        (17, long), (18, "a" * 30_000), (19, "".join(rng.choice("abcdefgh") for _ in range(30_000))), (20, " " * 20_000),
        (21, "tab\x1csep\x85nbsp end <|endoftext|> <|startoftext|>x"), (22, passage.upper()), (None, passage),
        (None, None), (None, "x " + passage), (-5, passage + " end"), (23, "日本語" * 4000), (24, "á ́b"),
    ]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(rows_of(edge_texts()), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def as_lists(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_docs(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


__all__ = ["F", "as_lists", "edge_texts", "rows_of", "SCHEMA"]
