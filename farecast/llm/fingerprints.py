"""Document fingerprints: mergeable bottom-k sketches of shingle hashes (2).

A sketch is the k smallest distinct 48-bit hashes of a text's word shingles
(all of them where there are no more) and whether that is the whole set. The k smallest of the union of two sketches are the sketch of the
joined shingle sets, so sketches merge across parts in any order. From two
sketches follow the resemblance (the share of the union's k smallest that
both hold), the containment, and the number of distinct shingles (of a whole
set the very number, else (k - 1) / the k-th smallest hash as a fraction of the
hash range).

A fingerprint is base64 text: one byte ``W`` (whole) or ``K`` (the k smallest
of more), then eight characters a hash, ascending; an empty set is ``W`` alone. Equal texts
have equal fingerprints. Words are runs of anything but ASCII white space,
A-Z lowered; a text with fewer words than the shingle is one shingle. Null
text is empty. Two empty sets have likeness 1, an empty and another 0.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from farecast.llm.common import bound_batches, map_slices
from farecast.llm.shingles import hashed_words, lowered, shingle_hashes

K = 128
WORDS = 5
RANGE = 1 << 48


class Sketch(NamedTuple):
    """The k smallest distinct hashes, ascending, and whether they are the whole set."""

    hashes: np.ndarray
    whole: bool


def sketch(shingles: np.ndarray, k: int = K) -> Sketch:
    top = shingles >> np.uint64(16)
    if len(top) > 4 * k:  # duplicates among the smallest are rare, but must not shorten the sketch
        some = np.unique(np.partition(top, 2 * k)[: 2 * k])
        if len(some) > k:
            return Sketch(some[:k], False)
    top = np.unique(top)
    return Sketch(top[:k], len(top) <= k)


def sketches(texts: list[str | None], k: int = K, words: int = WORDS) -> list[Sketch]:
    return [sketch(shingle_hashes(w, words), k) for w in hashed_words([lowered(t) for t in texts])]


def to_text(s: Sketch) -> str:
    raw = s.hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
    return ("W" if s.whole else "K") + base64.b64encode(raw).decode()


def from_text(t: str) -> Sketch:
    raw = np.frombuffer(base64.b64decode(t[1:]), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 2:] = raw
    return Sketch(out.reshape(-1).view(">u8").astype(np.uint64), t[0] == "W")


def merge(*parts: Sketch, k: int = K) -> Sketch:
    """The sketch of the union of the parts' sets."""
    if not parts:
        return Sketch(np.zeros(0, np.uint64), True)
    union = np.unique(np.concatenate([p.hashes for p in parts]))
    return Sketch(union[:k], len(union) <= k and all(p.whole for p in parts))


def distinct_count(s: Sketch) -> float:
    n = len(s.hashes)
    return float(n) if s.whole else (n - 1) / ((float(s.hashes[-1]) + 1) / RANGE)


def _shared(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """(of the union's k smallest those in both, their number)."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    twin = np.flatnonzero(both[1:] == both[:-1])
    n = len(both) - len(twin)
    if n <= k:
        return len(twin), n
    bound = np.unique(both)[k - 1]
    return int((both[twin] <= bound).sum()), k


def resemblance(a: Sketch, b: Sketch, k: int = K) -> float:
    """Estimated Jaccard similarity of the two shingle sets."""
    if not len(a.hashes) or not len(b.hashes):
        return 1.0 if len(a.hashes) == len(b.hashes) else 0.0
    same, n = _shared(a.hashes, b.hashes, k)
    return same / n


def containment(a: Sketch, b: Sketch, k: int = K, r: float | None = None) -> float:
    """Estimated share of a's shingles that b has (1 for an empty a); ``r`` is their resemblance, if known."""
    if not len(a.hashes):
        return 1.0
    r, n = resemblance(a, b, k) if r is None else r, distinct_count(a)
    return min(1.0, r * (n + distinct_count(b)) / ((1 + r) * n))


def fingerprint(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """(doc_id, fingerprint, distinct_shingles) per row."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("distinct_shingles", T.DoubleType()),
        ]
    )

    def make():
        def fn(c):
            got = sketches(c["text"], k, words)
            return {
                "doc_id": c["doc_id"],
                "fingerprint": [to_text(s) for s in got],
                "distinct_shingles": [distinct_count(s) for s in got],
            }

        return fn

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema)


def merge_by(prints: DataFrame, by: list[str], k: int = K, salts: int = 64) -> DataFrame:
    """One fingerprint per group of ``by`` from its documents' fingerprints.

    Each salted part of a group keeps its k smallest hashes first, so a group
    with a third of all rows is merged by many tasks; the last step sees at
    most salts * k hashes a group. Null fingerprints add nothing.
    """
    keys = [F.col(c) for c in by]
    hashes = prints.select(
        *keys,
        F.pmod(F.xxhash64("fingerprint"), F.lit(salts)).alias("__salt"),
        F.explode(F.expr("regexp_extract_all(substring(fingerprint, 2), '.{8}', 0)")).alias("__h"),
    ).withColumn("__v", F.hex(F.unbase64("__h")))
    hashes = hashes.where(F.col("__v") != "").dropDuplicates([*by, "__salt", "__v"])
    part = Window.partitionBy(*by, "__salt").orderBy("__v")
    kept = hashes.withColumn("__r", F.row_number().over(part)).where(F.col("__r") <= k + 1)
    kept = kept.dropDuplicates([*by, "__v"])
    whole = Window.partitionBy(*by).orderBy("__v")
    kept = kept.withColumn("__r", F.row_number().over(whole)).where(F.col("__r") <= k + 1)
    first = F.collect_list(F.when(F.col("__r") <= k, F.struct("__v", "__h")))
    text = F.concat_ws("", F.transform(F.sort_array(first), lambda x: x["__h"]))
    merged = kept.groupBy(*by).agg(text.alias("t"), F.max("__r").alias("n"))
    cut = F.coalesce(F.max(F.substring("fingerprint", 1, 1) == "K"), F.lit(False))
    groups = prints.groupBy(*by).agg(cut.alias("cut"))
    same = [groups[c].eqNullSafe(merged[c]) for c in by]
    kind = F.when(F.col("cut") | (F.coalesce("n", F.lit(0)) > k), "K").otherwise("W")
    print_ = F.concat(kind, F.coalesce("t", F.lit(""))).alias("fingerprint")
    return groups.join(merged, same, "left").select(*[groups[c] for c in by], print_)


EDITED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        # further columns: from the sketches alone
        T.StructField("distinct_shingles", T.DoubleType()),
        T.StructField("kept_by_edit", T.DoubleType()),  # containment of the text in its edited text
        T.StructField("in_next", T.DoubleType()),  # and in the next document
        T.StructField("distinct_with_next", T.DoubleType()),  # of the merged sketch
    ]
)


def edited_fingerprints(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness (``EDITED``).

    The edited text's last third (floor of the code points / 3) is the
    beginning of the next document in descending doc_id order; after the last
    comes the first. Ties are in order of text hash, then text; null ids are
    last. With one row the next document is the row itself.

    Texts are shuffled once: ids are cut into ranges at quantiles (a bounded
    sample), each range is sorted in its task, and the rows of each range's
    first id go to the range before, too (at most one id per range reaches
    the driver). Rows of one id stay in one range, as a sorted stream.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = _cuts(base.select("doc_id"), parts)
    if cuts is None:
        return spark.createDataFrame([], EDITED)
    found = _ranged(base.select("doc_id"), cuts, {}).groupBy("to").agg(
        F.max("doc_id").alias("first"), F.count("doc_id").alias("n")
    )
    firsts = sorted((r["to"], r["first"]) for r in found.collect())
    before = {_key(first): firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    sorted_ = (
        _ranged(base, cuts, before)
        .withColumn("h", F.xxhash64("text"))
        .repartitionById(len(cuts) + 1, "to")  # a range is a task: hashing their numbers would put several into one
        .sortWithinPartitions("to", "guest", F.col("doc_id").desc_nulls_last(), "h", "text")
        .select("doc_id", "text", "to", "guest")
    )

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(EDITED)
        held: list[tuple] = []  # (doc_id, text, next text)
        last = None  # (range, doc_id, text) of a row that waits for the next one

        def flush():
            texts = [t for _, t, _ in held]
            edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for _, t, n in held]
            a, b, c = sketches(texts, k, words), sketches(edited, k, words), sketches([n for _, _, n in held], k, words)
            near_edited = [resemblance(x, y, k) for x, y in zip(a, b)]
            near_next = [resemblance(x, y, k) for x, y in zip(a, c)]
            cols = [
                [i for i, _, _ in held],
                [len(t) for t in texts],
                [hashlib.sha256(e.encode("utf-8")).hexdigest() for e in edited],
                [to_text(x) for x in a],
                [to_text(x) for x in b],
                near_edited,
                near_next,
                [distinct_count(x) for x in a],
                [containment(x, y, k, r) for x, y, r in zip(a, b, near_edited)],
                [containment(x, y, k, r) for x, y, r in zip(a, c, near_next)],
                [distinct_count(merge(x, y, k=k)) for x, y in zip(a, c)],
            ]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, out)], schema=out)

        for got in batches:
            for at in range(0, got.num_rows, 256):
                part = got.slice(at, 256).to_pydict()
                for doc_id, text, to, guest in zip(part["doc_id"], part["text"], part["to"], part["guest"]):
                    text = text or ""
                    if last is not None and last[0] == to:
                        held.append((last[1], last[2], text))
                    last = None if guest else (to, doc_id, text)
                if len(held) >= 256:
                    yield flush()
        if held:
            yield flush()

    return sorted_.mapInArrow(run, EDITED)


def _key(doc_id: int | None) -> tuple:
    """Sort key of the descending order, null ids last."""
    return (1, 0) if doc_id is None else (0, -doc_id)


def _ranged(docs: DataFrame, cuts: list[tuple], before: dict[tuple, int]) -> DataFrame:
    """Rows with their range ``to``; those whose id is in ``before`` also as a guest of the range named there."""
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("to", T.IntegerType()), T.StructField("guest", T.BooleanType())]
    )
    names = docs.columns

    def make():
        def fn(c):
            keys = [_key(i) for i in c["doc_id"]]
            own = [bisect_right(cuts, key) for key in keys]
            sent = [i for i, key in enumerate(keys) if key in before]
            out = {n: c[n] + [c[n][i] for i in sent] for n in names}
            out["to"] = own + [before[keys[i]] for i in sent]
            out["guest"] = [False] * len(own) + [True] * len(sent)
            return out

        return fn

    return map_slices(docs, make, schema)


def _cuts(ids: DataFrame, parts: int) -> list[tuple] | None:
    """At most parts - 1 distinct range starts, from a bounded sample of the ids; None for an empty table."""
    n = ids.count()
    if not n:
        return None
    bound = 64 * parts
    some = ids.sample(min(1.0, 1.2 * bound / n), seed=1).limit(2 * bound) if n > bound else ids
    rows = sorted(_key(r[0]) for r in some.collect())
    return sorted({rows[len(rows) * i // parts] for i in range(1, parts)}) if rows else []
