from __future__ import annotations

import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
EXTRA = "n rid key token text_hash label score h to guest bits node comp entry bucket held_out sequence_id".split()
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in EXTRA],
    ]
)
LABELS = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "quality", "toxic")])


def make_docs(spark, rows):
    """rows of (doc_id, text[, lang]); extra columns hold texts that must not be touched."""
    full = []
    for r in rows:
        doc_id, text, lang = (*r, None)[:3]
        full.append((doc_id, text, lang, "s", None if text is None else len(text), *["x"] * len(EXTRA)))
    return spark.createDataFrame(full, SCHEMA).repartition(3)


EDGE = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en"),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en"),  # a repeated row
    (2, None, None),
    (3, "", "en"),
    (4, " \t\n ", "en"),
    (5, "one", "de"),
    (None, "a text without an id but with some words in it", None),
    (None, None, None),
    (6, LONG, "en"),
    (7, "x" * 50_000, "en"),
    (8, "Grüße 🙂 中文 ́e mail a.b@c.de 10.0.0.1 und 4111 1111 1111 1111 +1 (555) 123-4567", "de"),
    (9, "THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG AGAIN AND AGAIN", "en"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return make_docs(spark, EDGE)


@pytest.fixture(scope="session")
def empty(spark):
    return make_docs(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (5, 1, 1), (6, 0, 0)], LABELS
    )


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)
