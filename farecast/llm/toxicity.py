"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text (10).

Folding lowers letters, drops accents, maps look-alike letters of other
scripts to Latin ones and digits or signs inside words to the letters they
stand for (``1d10t``, ``l0ser``, ``tr@sh``); the lexicon is folded alike, so
both meet. An entry is a whole word or a word beginning, with a weight: the
log odds of its document counts in toxic and other labelled texts. Entries,
and exceptions (longer words of an entry that only clean texts have), are
learned from a bounded sample of labelled rows (``SAMPLE_ROWS``); phrases in
``EXCEPTIONS`` never count. Seed words that no clean text of the sample has
are entries, too; without labels they are the lexicon.

A document's hits are summed, once in relation to its length and once as a
logarithm; a logistic model over the two, fitted on the same sample, gives
the score. Null text counts as empty, and an empty text has the base score;
repeated rows stay; texts are read whole, however long; an empty table gives no
rows. Rows with a null label teach nothing. Other columns are never read.

Words are Latin-script words only: letters of other scripts that no Latin one
looks like part words, are neither learned nor matched, and a text in such a
script gets the base score.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.llm.common import fold_of, labelled_sample, map_slices

SAMPLE_ROWS = 24_000
CANDIDATES = 30_000  # word beginnings of toxic texts that are counted in the others
ENTRIES = 4_000
LEAST_ROWS = 3
LEAST_ODDS = 3.0
PREFIXES = (4, 5, 6)
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "rodeo clown")
SEED_WEIGHT = 4.0
SEED = ("idiot", "moron", "stupid", "loser", "scum", "worthless", "pathetic", "disgusting")

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
LOOK_ALIKE = dict(zip("авекмнорстухіѕјԁɡοανικρτυχ", "abekmhopctyxisjdgoavikptux"))
STANDS_FOR = dict(zip("013457@$!|", "oieastasii"))


def _table() -> bytes:
    out = bytearray(range(256))
    for i in range(256):
        c = unicodedata.normalize("NFKD", chr(i).lower())[:1]
        out[i] = ord(c) if c.isascii() and c.isalpha() else i
    for a, b in STANDS_FOR.items():
        out[ord(a)] = ord(b)
    out[ord("l")] = out[ord("L")] = ord("i")  # 1 stands for either
    return bytes(out)


_FOLD = _table()
_SIGNS = re.compile(rb"[@$!|]+(?![A-Za-z0-9@$!|])|(?<![A-Za-z])[0-9]+(?![A-Za-z])")
_HAS_SIGN = re.compile(rb"[@$!|0-9]").search
_WIDE = re.compile("[^\x00-\xff]").search
_WORDS = re.compile("[a-z]+").findall


def fold(text: str) -> str:
    """Folded text, one Latin-1 character each."""
    if _WIDE(text):
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
        text = text.lower().translate(_LOOKS)
    raw = text.encode("latin-1", "replace")
    if _HAS_SIGN(raw):  # signs behind a word, and numbers on their own, are no letters
        raw = _SIGNS.sub(b" ", raw)
    return raw.translate(_FOLD).decode("latin-1")


_LOOKS = str.maketrans(LOOK_ALIKE)


def _entries(words: set[str]) -> set[str]:
    """Whole words end in a space."""
    return {f"{w} " for w in words if len(w) > 2} | {w[:n] for w in words for n in PREFIXES if len(w) >= n}


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    logistic: tuple[float, float, float] = (-3.0, 2.0, 1.0)
    _trie: object = field(default=None, repr=False, compare=False)

    def trie(self):
        if self._trie is None:
            import ahocorasick

            self._trie = ahocorasick.Automaton()
            for w, x in self.weights.items():
                self._trie.add_word(f" {w}", (len(w) + 1, x))
            for e in self.exceptions:
                self._trie.add_word(f" {fold(e)} ", (len(e) + 2, None))
            self._trie.make_automaton()
        return self._trie

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "logistic": self.logistic, "_trie": None}

    def hits(self, text: str | None) -> tuple[float, int]:
        """(sum of the hits' weights, number of words); at one word the heaviest entry counts."""
        if not text:
            return 0.0, 0
        folded = _NOT_LETTER.sub(" ", f" {fold(text)} ")
        n = folded.count(" ") - 1
        if not self.weights:
            return 0.0, n
        found: dict[int, float] = {}
        skip: list[tuple[int, int]] = []
        for end, (size, weight) in self.trie().iter(folded):
            at = end - size + 1
            if weight is None:
                skip.append((at, end))
            elif weight > found.get(at, 0.0):
                found[at] = weight
        for a, b in skip:
            for at in [x for x in found if a <= x < b]:
                del found[at]
        return sum(found.values()), n

    def features(self, text: str | None) -> tuple[float, float]:
        total, n = self.hits(text)
        return float(np.log1p(total)), total / (n + 20.0) ** 0.5

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts], np.float64).reshape(-1, 2)
        b, w1, w2 = self.logistic
        return 1 / (1 + np.exp(-np.clip(b + w1 * x[:, 0] + w2 * x[:, 1], -40, 40)))


_NOT_LETTER = re.compile("[^a-z]+")


def _count(rows: DataFrame, wanted: frozenset | None) -> DataFrame:
    """(entry, documents) over the rows' texts; a slice of rows is summed before it leaves its task."""
    schema = T.StructType([T.StructField("entry", T.StringType()), T.StructField("n", T.LongType())])

    def make():
        def fn(c):
            tally: Counter = Counter()
            for t in c["text"]:
                got = _entries(set(_WORDS(fold(t or ""))))
                tally.update(got if wanted is None else got & wanted)
            return {"entry": list(tally), "n": list(tally.values())}

        return fn

    return map_slices(rows.select("text"), make, schema).groupBy("entry").agg(F.sum("n").alias("n"))


def _fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Newton steps; the ridge keeps separable data finite."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(3)
        w -= np.linalg.solve(h, a.T @ (p - y) + ridge * w)
    return tuple(float(v) for v in w)


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", mod: int = 4, held_out: int = 2, rows: int = SAMPLE_ROWS
) -> Lexicon:
    """Lexicon and score from at most ``rows`` labelled documents outside the held-out fold."""
    spark: SparkSession = docs.sparkSession
    sample = labelled_sample(spark, labels, label, mod, held_out, rows, T.LongType())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
    sizes = dict(map(tuple, sample.groupBy("label").count().collect()))
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Lexicon({fold(w) + " ": SEED_WEIGHT for w in SEED})
    top = _count(texts.where("label = 1"), None).where(F.col("n") >= LEAST_ROWS).orderBy(F.desc("n"), "entry").limit(CANDIDATES)
    counts = {r["entry"]: r["n"] for r in top.collect()}
    seeds = {fold(w) + " " for w in SEED}
    others = {r["entry"]: r["n"] for r in _count(texts.where("label = 0"), frozenset(counts) | seeds).collect()}
    odds = {
        e: float(np.log((n + 0.5) / (bad + 1)) - np.log((others.get(e, 0) + 0.5) / (good + 1))) for e, n in counts.items()
    }
    weights: dict[str, float] = {}
    for e in sorted(odds, key=lambda e: (len(e), e)):  # a beginning covers longer entries that are no stronger
        if odds[e] >= LEAST_ODDS and not any(weights.get(e[:n], -9.0) >= odds[e] - 0.5 for n in PREFIXES if n < len(e)):
            weights[e] = odds[e]
    weights = dict(sorted(weights.items(), key=lambda kv: (-kv[1] * counts[kv[0]], kv[0]))[:ENTRIES])
    for e in seeds:  # known words that the sample is too small to show
        if not others.get(e) and not any(e[:n] in weights for n in PREFIXES):
            weights.setdefault(e, SEED_WEIGHT)
    clean = {
        e.strip() for e, n in others.items() if e.endswith(" ") and n >= LEAST_ROWS and odds.get(e, 0.0) < 0 and any(e[:k] in weights for k in PREFIXES)
    }
    model = Lexicon(weights, tuple(sorted({*EXCEPTIONS, *clean})))
    schema = T.StructType(
        [T.StructField("label", T.IntegerType()), T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType())]
    )

    def make():
        def fn(c):
            x = [model.features(t) for t in c["text"]]
            return {"label": c["label"], "a": [v for v, _ in x], "b": [v for _, v in x]}

        return fn

    got = sorted(map(tuple, map_slices(texts.select("label", "text"), make, schema).limit(2 * rows).collect()))
    x = np.array([r[1:] for r in got], np.float64).reshape(len(got), 2)
    model.logistic = _fit_logistic(x, np.array([r[0] for r in got], np.float64))
    return model


def score(docs: DataFrame, model: Lexicon, mod: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
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
            s = model.score(c["text"])
            return {
                "doc_id": c["doc_id"],
                "held_out": [fold_of(i, mod) == held_out for i in c["doc_id"]],
                "score": s,
                "predicted": (s >= threshold).astype(np.int32),
            }

        return fn

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema)
