"""Quality rules: base counts and a hashed n-gram log-likelihood ratio (7).

Base counts come from each whole text. The verdict compares two multinomials
over hashed byte n-grams (n = 3, ``BITS`` bits, case kept): the raw one counts all
documents, the trusted one all documents labelled good. A text's score is the
mean of log(trusted / raw) over its n-grams; it is kept when the score reaches
the threshold, a fixed low quantile of the trusted documents' own scores less
a margin, and no base rule fails. Every text is held against the same
threshold; nothing is drawn.

Counts are summed per task before they are shuffled (one row per bucket and
task), and 2**BITS sums reach the driver whatever the input. The quantile is
exact: scores, written without their texts, are counted by parts of their
range until the part that holds the position is one score. Trusted ids are
not broadcast: every text is shuffled once to meet them.

Null text counts as empty: no words, so the base rule fails. Texts without
an n-gram score 0. With no labelled good text the ratio keeps everything.
Repeated rows are judged and counted once each; texts are read whole, however
long; an empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.llm.common import bound_batches, map_slices
from farecast.llm.shingles import _BLANK, hashed_words, shingle_hashes
from farecast.session import scratch_path

BITS = 14
PARTS = 4_096  # a pass of the selection brings at most one count more to the driver
QUANTILE = 0.002
MARGIN = 0.25  # texts of a few words vary; junk lies far lower
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def grams(raw: bytes) -> np.ndarray:
    """Bucket of every byte 3-gram."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    g = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (g * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def base_counts(texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of each text."""
    raws = [(t or "").encode("utf-8") for t in texts]
    out = []
    for t, raw, words in zip(texts, raws, hashed_words(raws)):
        buf = np.frombuffer(raw, np.uint8)
        lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        n, repeated = len(words), 0
        if n >= 5:
            windows = shingle_hashes(words, 5)
            _, where, count = np.unique(windows, return_inverse=True, return_counts=True)
            again = count[where] > 1
            if again.any():
                covered = np.zeros(n, bool)
                for k in range(5):
                    covered[k : n - 4 + k] |= again
                repeated = int(covered.sum())
        out.append((n, len(t or "") - int(_BLANK[buf].sum()), int(_SYMBOL[buf].sum()), len(lines) - len(set(lines)), repeated))
    return out


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


@dataclass
class Ratio:
    log_ratio: np.ndarray
    threshold: float = -np.inf

    def score(self, text: str | None) -> float:
        g = grams((text or "").encode("utf-8"))
        return float(self.log_ratio[g].mean()) if len(g) else 0.0


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """n-gram counts over all texts of ``docs``.

    Every task gives a row for each bucket it met, so there are a few tasks a core, not one a partition."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])
    bound_batches(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        total = np.zeros(1 << BITS, np.int64)
        for got in batches:
            for at in range(0, got.num_rows, 256):
                for t in got.column(0).slice(at, 256).to_pylist():
                    if t:
                        total += np.bincount(grams(t.encode("utf-8")), minlength=1 << BITS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=schema.names)

    out = np.zeros(1 << BITS, np.float64)
    texts = docs.select("text").coalesce(4 * docs.sparkSession.sparkContext.defaultParallelism)
    for r in texts.mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def nth_smallest(scores: DataFrame, position: Callable[[int], int]) -> float:
    """The value of ``s`` at a 0-based position of its order, given by the number of rows (one at least)."""
    rows, low, high = scores.agg(F.count("s"), F.min("s"), F.max("s")).first()
    at = position(rows)
    while low < high:
        inside = scores.where((F.col("s") >= F.lit(low)) & (F.col("s") <= F.lit(high)))
        part = F.floor((F.col("s") - F.lit(low)) / F.lit(high - low) * F.lit(PARTS)).alias("part")
        parts = inside.groupBy(part).agg(F.count("s").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).collect()
        for p in sorted(parts, key=lambda r: r["part"]):
            if at < p["n"]:
                break
            at -= p["n"]
        low, high = p["low"], p["high"]
    return low


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ratio:
    """The ratio and its threshold; ``labels`` marks trusted documents with 1."""
    spark: SparkSession = docs.sparkSession
    # trusted ids grow with the labels, so they are never broadcast: texts are shuffled to them, once
    trusted = labels.where(F.col(label) == 1).select(F.col("doc_id").cast("long").alias("doc_id")).distinct().hint("merge")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    target = bucket_counts(docs.join(trusted, "doc_id", "left_semi"))
    if not target.sum():
        return Ratio(np.zeros(1 << BITS))
    raw = bucket_counts(docs)
    smooth = 0.5
    log_ratio = np.log((target + smooth) / (target + smooth).sum()) - np.log((raw + smooth) / (raw + smooth).sum())
    model = Ratio(log_ratio)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("s", T.DoubleType())])

    def make():
        return lambda c: {"doc_id": c["doc_id"], "s": [model.score(t) for t in c["text"]]}

    path = scratch_path(spark, "rules-scores")  # ids meet scores here, so no text is shuffled for the threshold
    map_slices(docs, make, schema).join(trusted, "doc_id", "left_semi").select("s").write.parquet(path)
    scores = spark.read.schema("s double").parquet(path)
    model.threshold = nth_smallest(scores, lambda rows: int(QUANTILE * rows)) - MARGIN
    return model


RULES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("log_ratio", T.DoubleType()),
    ]
)


def judge(docs: DataFrame, model: Ratio) -> DataFrame:
    """Counts and verdict per row (``RULES``)."""

    def make():
        def fn(c):
            counts = base_counts(c["text"])
            failed = [base_failed(x[0], x[4]) for x in counts]
            s = [model.score(t) for t in c["text"]]
            out = {n: [x[i] for x in counts] for i, n in enumerate(RULES.names[1:6])}
            kept = [not f and v >= model.threshold for f, v in zip(failed, s)]
            return {"doc_id": c["doc_id"], **out, "base_failed": failed, "kept": kept, "log_ratio": s}

        return fn

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, RULES)
