"""Quality classifier: boosted trees over document statistics (6).

Statistics of the whole text (characters, words, lines, repetition) are one
vector per document. The trees learn on the driver from the vectors of a
bounded sample of labelled rows (``SAMPLE_ROWS``, the smallest id hashes
outside the held-out fold; only ids are broadcast, only vectors come back)
and go out as flat arrays; scoring is a map over all texts.

Null text counts as empty; empty texts are scored like any others. Repeated
rows stay. Texts are read whole, however long. Without labels every score is
the base rate 0.5; rows with a null label teach nothing. An empty table gives
no rows. Other columns are never read (``keep_good`` carries them along).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.llm.boost import Trees, fit
from farecast.llm.common import fold_of, labelled_sample, map_slices
from farecast.llm.shingles import _BLANK

SAMPLE_ROWS = 12_000

FEATURES = [
    "log_bytes", "log_words", "word_length", "blank", "digit", "upper", "letter", "non_ascii", "punctuation", "symbol",
    "exclamation", "bar", "comma", "line_length", "repeat_line", "short_line", "distinct_word", "top_word",
    "repeat_word", "repeat_run", "repeat_pair", "marked_word", "upper_word", "byte_entropy", "lone_symbol",
]


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _class(b"#*$%&|<>")
_PUNCT = _class(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
_CASE_BIT = 0xDF


def statistics(text: str | None) -> list[float]:
    """The feature vector of one whole text (``FEATURES``)."""
    raw = (text or "").encode("utf-8")
    words = raw.split()
    n, m = len(raw), len(words)
    if not m:
        return [float(np.log1p(n)), *[0.0] * (len(FEATURES) - 1)]
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    blank = counts[_BLANK].sum()
    solid = max(1, n - blank)
    upper = counts[65:91].sum()
    letters = upper + counts[97:123].sum()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    top = max(tally.values())
    adjacent = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    run = best = 1
    if adjacent:
        for a, b in zip(words, words[1:]):
            run = run + 1 if a == b else 1
            best = max(best, run)
    p = counts[counts > 0] / n
    marks = sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1] not in b".,;:" for w in words)
    return [
        float(np.log1p(n)),
        float(np.log1p(m)),
        (n - blank) / m,
        blank / n,
        counts[48:58].sum() / solid,
        upper / max(1, letters),
        letters / solid,
        counts[128:].sum() / solid,
        counts[_PUNCT].sum() / solid,
        counts[_SYMBOL].sum() / solid,
        counts[33] / m,
        counts[124] / m,
        counts[44] / m,
        m / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(len(x) < 20 for x in lines) / len(lines),
        len(tally) / m,
        top / m,
        adjacent / m,
        float(best),
        1 - pairs / max(1, m - 1) if m > 1 else 0.0,
        marks / m,
        sum(w.isupper() and len(w) > 1 for w in words) / m,
        float(-(p * np.log2(p)).sum()),
        float(sum(len(w) == 1 and bool(_PUNCT[w[0]]) for w in words)) / m,
    ]


def _matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "quality", mod: int = 3, held_out: int = 1, rows: int = SAMPLE_ROWS
) -> Trees:
    """Fit on at most ``rows`` labelled documents outside the held-out fold."""
    spark: SparkSession = docs.sparkSession
    sample = labelled_sample(spark, labels, label, mod, held_out, rows, T.LongType())
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id").select("label", "text")

    def make():
        return lambda c: {"label": c["label"], "x": [statistics(t) for t in c["text"]]}

    # repeated rows of one id are taken once each, but never more than the bound
    got = map_slices(wanted, make, schema).limit(2 * rows).collect()
    got.sort(key=lambda r: (r[0], r[1]))
    x = np.array([r[1] for r in got], np.float64).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r[0] for r in got], np.float64))


def score(docs: DataFrame, model: Trees, mod: int = 3, held_out: int = 1, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )

    def make():
        def fn(c):
            s = model.score(_matrix(c["text"]))
            return {
                "doc_id": c["doc_id"],
                "held_out": [fold_of(i, mod) == held_out for i in c["doc_id"]],
                "score": s,
                "predicted": (s >= threshold).astype(np.int32),
            }

        return fn

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema)


def keep_good(docs: DataFrame, model: Trees, threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""

    def run(batches):
        import pyarrow as pa

        for got in batches:
            for at in range(0, got.num_rows, 256):
                part = got.slice(at, 256)
                s = model.score(_matrix(part.column(part.schema.get_field_index("text")).to_pylist()))
                yield part.filter(pa.array(s >= threshold))

    from farecast.llm.common import bound_batches

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
