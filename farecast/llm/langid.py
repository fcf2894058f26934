"""Language identification with string kernels (3).

The kernel of two texts is the number of hashed byte n-grams (n = 2 to 4 of
the A-Z-lowered UTF-8 text) that both hold, over the geometric mean of their
own numbers: a blended-spectrum presence kernel, normalised. Landmarks, as
many per language, give the Nyström map K(x, L) K(L, L)^(-1/2); on it one
ridge regression per language is solved in closed form on targets +1 / -1.

Texts become presence bits (4 KB whatever their length). A bounded sample
(``SAMPLE_ROWS`` smallest id hashes of the learning folds) of those bits
comes to the driver for the fit; scoring multiplies batches of presence rows
with the landmark matrix, then with the regressors.

A text that is null or has no letter is ``und`` with score 0. Ties go to the
language first in order. With no learnable row every prediction is ``und``.
Repeated rows are predicted once each; texts are read whole, however long; an
empty table gives no rows. Other columns are never read.

The regression always names some language, with 1 / (number of languages) or
more, so ``keep_known`` identifies every text and then asks whether it is as
familiar as texts of the language it was given: the familiarity is the mean
over a text's n-grams, each time they occur, of the share of a language's
landmarks that hold them (the language with the most), less what any n-gram
has on average. It is near 0 for foreign scripts and random signs, whatever
their length, and does not fall where known languages are mixed. What is usual
for a language comes from all its documents: their familiarity is counted by
steps of 1 / ``STEPS``, and those counts reach the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.llm.common import bound_batches, fold, fold_of, hash_sample, map_slices

BITS = 15
SAMPLE_ROWS = 4_000
LANDMARKS = 48  # per language
RIDGE = 1e-2
STEPS = 4_096  # a language's documents bring at most one count more to the driver
NONE = "und"
_letter = re.compile(r"[^\W\d_]").search
_MULTIPLY = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def _grams(text: str):
    """Hashes of the n-grams where they occur, an array for each n."""
    b = np.frombuffer(f" {text} ".encode("utf-8").lower(), np.uint8).astype(np.uint32)
    gram = b
    for size, factor in zip((2, 3, 4), _MULTIPLY):
        if len(b) < size:
            break
        gram = (gram[: len(b) - size + 1] << np.uint32(8)) | b[size - 1 :]
        yield (gram * np.uint32(factor)) >> np.uint32(32 - BITS)


def presence(text: str) -> np.ndarray:
    """One byte per hashed n-gram: 1 if the text holds it."""
    out = np.zeros(1 << BITS, np.uint8)
    for grams in _grams(text):
        out[grams] = 1
    return out


def familiarity(text: str | None, shares: np.ndarray) -> float:
    """0 for a text without a letter."""
    if not text or not _letter(text):
        return 0.0
    got = [shares[grams] for grams in _grams(text)]
    return max(0.0, sum(float(x.sum(dtype=np.float64)) for x in got) / sum(map(len, got)))


def _rows(texts: list[str]) -> np.ndarray:
    out = np.empty((len(texts), 1 << BITS), np.float32)
    for i, t in enumerate(texts):
        out[i] = presence(t)
    return out


@dataclass
class Kernel:
    langs: list[str]
    landmarks: np.ndarray  # presence bits, packed
    weights: np.ndarray  # landmarks x languages: the Nyström map and the regressors in one
    bias: np.ndarray
    owner: np.ndarray | None = None  # language of each landmark

    def shares(self) -> np.ndarray:
        """Per n-gram, the largest share of a language's landmarks that hold it, less the mean, up to 1."""
        bits = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        most = np.max([bits[self.owner == j].mean(0) for j in range(len(self.langs))], axis=0)
        return (most - most.mean()) / max(1 - float(most.mean()), 1e-6)

    def unpacked(self) -> np.ndarray:
        bits = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        return (bits / np.sqrt(bits.sum(1, keepdims=True))).T.copy()

    def decide(self, rows: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """Regression values, rows x languages."""
        k = rows @ matrix / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))
        return k @ self.weights + self.bias


def fit_kernel(bits: np.ndarray, langs: list[str], per_language: int = LANDMARKS, ridge: float = RIDGE) -> Kernel:
    """Fit from packed presence bits (rows x bytes) and their languages."""
    names = sorted(set(langs))
    if not names:
        return Kernel([], np.zeros((0, (1 << BITS) // 8), np.uint8), np.zeros((0, 0), np.float32), np.zeros(0, np.float32))
    where = np.array([names.index(x) for x in langs])
    marks = np.concatenate([np.flatnonzero(where == j)[:per_language] for j in range(len(names))])
    model = Kernel(names, bits[marks], None, None, where[marks])
    matrix = model.unpacked()
    blocks = []
    for at in range(0, len(bits), 256):
        rows = np.unpackbits(bits[at : at + 256], axis=1).astype(np.float32)
        blocks.append(rows @ matrix / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1)))
    k = np.concatenate(blocks).astype(np.float64)
    values, vectors = np.linalg.eigh(k[marks])
    good = values > 1e-6 * max(values.max(), 1e-12)
    nystrom = vectors[:, good] / np.sqrt(values[good])
    phi = k @ nystrom
    size = np.bincount(where, minlength=len(names))
    weight = (len(where) / (len(names) * size))[where]  # languages count alike
    target = np.where(where[:, None] == np.arange(len(names)), 1.0, -1.0)
    mean_x = (weight[:, None] * phi).sum(0) / weight.sum()
    mean_y = (weight[:, None] * target).sum(0) / weight.sum()
    a, b = phi - mean_x, target - mean_y
    beta = np.linalg.solve(a.T @ (weight[:, None] * a) + ridge * len(where) * np.eye(a.shape[1]), a.T @ (weight[:, None] * b))
    model.weights = (nystrom @ beta).astype(np.float32)
    model.bias = (mean_y - mean_x @ beta).astype(np.float32)
    return model


def learn(docs: DataFrame, mod: int = 5, held_out: int = 0, rows: int = SAMPLE_ROWS) -> Kernel:
    """Fit on at most ``rows`` documents with a language outside the held-out fold."""
    known = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(mod) != held_out)
    ids = hash_sample(docs.where(known).select("doc_id"), ["doc_id"], rows).distinct()
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("bits", T.BinaryType())])
    wanted = docs.where(known).select("doc_id", "lang", "text").join(F.broadcast(ids), "doc_id").select("lang", "text")

    def make():
        def fn(c):
            kept = [(g, t) for g, t in zip(c["lang"], c["text"]) if t and _letter(t)]
            return {"lang": [g for g, _ in kept], "bits": [np.packbits(presence(t)).tobytes() for _, t in kept]}

        return fn

    got = sorted(map(tuple, map_slices(wanted, make, schema).limit(2 * rows).collect()), key=lambda r: (r[0], bytes(r[1])))
    order = np.random.default_rng(0).permutation(len(got))
    bits = np.array([np.frombuffer(bytes(got[i][1]), np.uint8) for i in order], np.uint8).reshape(len(got), (1 << BITS) // 8)
    return fit_kernel(bits, [got[i][0] for i in order])


def predict(texts: list[str | None], model: Kernel, matrix: np.ndarray, batch: int = 64) -> tuple[list[str], np.ndarray]:
    langs, scores = [NONE] * len(texts), np.zeros(len(texts))
    where = [i for i, t in enumerate(texts) if t and model.langs and _letter(t)]
    for at in range(0, len(where), batch):
        part = where[at : at + batch]
        values = model.decide(_rows([texts[i] for i in part]), matrix)
        best = values.argmax(1)
        scores[part] = np.clip((values[np.arange(len(part)), best] + 1) / 2, 0, 1)
        for i, j in zip(part, best.tolist()):
            langs[i] = model.langs[j]
    return langs, scores


def identify(docs: DataFrame, model: Kernel, mod: int = 5, held_out: int = 0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def make():
        matrix = model.unpacked()

        def fn(c):
            langs, scores = predict(c["text"], model, matrix)
            return {
                "doc_id": c["doc_id"],
                "held_out": [fold_of(i, mod) == held_out for i in c["doc_id"]],
                "lang_pred": langs,
                "score": scores,
            }

        return fn

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema)


def low_quantile(x: np.ndarray, n: np.ndarray, q: float = 0.05) -> float:
    """The quantile of values ``x`` that occur ``n`` times each, as numpy's of the single values."""
    order = np.argsort(x)
    x, until = x[order], np.cumsum(n[order])
    at = q * (until[-1] - 1)
    low, high = x[np.searchsorted(until, [np.floor(at), np.ceil(at)], side="right")]
    return float(low + (at - np.floor(at)) * (high - low))


def usual_familiarity(docs: DataFrame, shares: np.ndarray) -> dict[str | None, float]:
    """What 19 of 20 documents of a language reach, for each language and, as None, for all with one."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("x", T.DoubleType())])

    def make():
        def fn(c):
            kept = [(g, t) for g, t in zip(c["lang"], c["text"]) if t and _letter(t)]
            return {"lang": [g for g, _ in kept], "x": [familiarity(t, shares) for _, t in kept]}

        return fn

    values = map_slices(docs.where(F.col("lang").isNotNull()).select("lang", "text"), make, schema)
    step = F.floor(F.col("x") * F.lit(STEPS))
    counts = values.groupBy("lang", step).agg(F.min("x").alias("x"), F.count("x").alias("n")).collect()
    groups: dict[str | None, list] = {}
    for r in counts:
        groups.setdefault(r["lang"], []).append((r["x"], r["n"]))
        groups.setdefault(None, []).append((r["x"], r["n"]))
    return {lang: low_quantile(*map(np.array, zip(*rows))) for lang, rows in groups.items()}


def keep_known(docs: DataFrame, model: Kernel, least: float = 0.75) -> DataFrame:
    """The rows, with all their columns, with a letter and ``least`` times the familiarity that is usual for
    their predicted language or more; a language without documents here is held to what is usual for all."""
    if not model.langs:
        return docs.where(F.lit(False))
    shares = model.shares()
    usual = usual_familiarity(docs, shares)
    bounds = {x: least * usual.get(x, usual.get(None, 0.0)) for x in model.langs}

    def run(batches):
        import pyarrow as pa

        from farecast.llm import common

        for clear in common._RELEASE:
            clear()
        matrix = model.unpacked()
        for got in batches:
            for at in range(0, got.num_rows, 256):
                part = got.slice(at, 256)
                texts = part.column(part.schema.get_field_index("text")).to_pylist()
                langs, _ = predict(texts, model, matrix)
                keep = [bool(t and _letter(t)) and familiarity(t, shares) >= bounds[x] for x, t in zip(langs, texts)]
                yield part.filter(pa.array(keep, pa.bool_()))

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
