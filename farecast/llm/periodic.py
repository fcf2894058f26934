"""Periodic runs of words (13): scale-tiled detection.

A run of period q is a maximal stretch of words in which words q apart are
identical, at least ``max(6, 4 * q)`` long, with q its smallest period.
Periods are handled by octave, Q <= q < 2 Q (Q a power of two):

1. A map over the documents numbers the words and takes, for every octave,
   all boundaries b (multiples of Q) and all q of the octave whose blocks of
   2 Q words at b and b + q have equal hashes -- one comparison a word and
   octave, in numpy over a slice of documents. Every run holds such a
   boundary, so a document without one has no run. The document is exploded
   into overlapping tiles of ``max(1024, 8 Q)`` boundaries' words per octave,
   and the tiles that hold such a boundary are written out.
2. Tiles are shuffled by (document, octave, place), so a long document is
   spread over many tasks, and solved on their own: the Z-function of the
   words from a boundary on, and that of the reversed words before it, give
   how far words q apart agree on both sides, for all q at once. What is
   found is a fragment: the stretch as far as the tile sees it.
3. Fragments are shuffled by (document, period) and stitched where they
   overlap; neighbouring tiles overlap by more than a fragment can hide.
   Long enough stretches are runs; of runs over the same words the smallest
   period stays (the others are its multiples).
4. Runs are gathered by document and meet its words (only documents with a
   tile carry theirs) to drop what repeats.

The words a slice compares at once are bounded (``SLICE_BYTES``, or one
document, of which a task holds some 60 bytes a word); a tile is bounded by its
octave. Step 1 is written to the shared
folder, which fixes the row numbers and cuts the lineage.

Nulls: a null text has no words; a null id is no number, so such a document
stays as it is (``impose``) and is returned with a null id. Empty texts have
no run: four nulls, the hash of no bytes twice. Repeated rows are documents
of their own. Empty tables give no rows. Texts are read whole, however long.
Other columns are never read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farecast.llm.common import bound_batches, columns, map_slices
from farecast.session import scratch_path

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
TILE = 1024  # boundaries' words of a tile, at least
SLICE_BYTES = 1 << 20
_R = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_RI = np.uint64(pow(int(_R), -1, 1 << 64))

NONE = hashlib.sha256(b"").hexdigest()


def split_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8."""
    return (text or "").encode("utf-8").split()


def impose(doc_id: int | None, words: list) -> list:
    """Documents whose crc32(id) is divisible by ten repeat a stretch of their own words up to the end."""
    n = len(words)
    if not n or doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


class _Powers:
    """r**i and its inverse modulo 2**64, kept as long as the longest slice."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            base = np.ones(size, np.uint64)
            base[1:] = _R
            self.up = np.multiply.accumulate(base)
            base[1:] = _RI
            self.down = np.multiply.accumulate(base)
        return self.up[:n], self.down[:n]


def equal_blocks(docs: list[np.ndarray], powers: _Powers | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(document, octave Q, boundaries, periods) whose blocks of 2 Q words have equal hashes.

    The documents lie side by side, longest first, with a number of its own after each, so no block
    that reaches over an end equals another; an octave looks at those long enough only."""
    powers = powers or _Powers()
    order = sorted((i for i in range(len(docs)) if len(docs[i]) >= LEAST_LENGTH), key=lambda i: -len(docs[i]))
    if not order:
        return
    parts = []
    for k, i in enumerate(order):
        parts += [docs[i], np.array([-1 - k])]
    x = np.concatenate(parts).astype(np.int64).view(np.uint64)
    lengths = np.array([len(docs[i]) for i in order])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    up, down = powers(len(x))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((x + np.uint64(1)) * _R * up)])
    q = 1
    while (long_enough := int((lengths >= max(LEAST_LENGTH, LEAST_EXPONENT * q)).sum())):
        end = int(starts[long_enough])
        m = end - 2 * q + 1
        h = (sums[2 * q : end + 1] - sums[:m]) * down[:m]
        rows = -(-m // q) + 1
        grid = np.zeros(rows * q, np.uint64)
        grid[:m] = h
        grid = grid.reshape(rows, q)
        j, t = np.nonzero(grid[1:] == grid[:-1, :1])
        inside = (j + 1) * q + t < m
        j, t = j[inside], t[inside]
        if len(j):
            b = j * q
            at = np.searchsorted(starts, b, side="right") - 1
            cut = np.flatnonzero(np.diff(at)) + 1
            for part, bs, ts in zip(np.split(at, cut), np.split(b, cut), np.split(t, cut)):
                yield order[part[0]], q, bs - starts[part[0]], ts + q
        q *= 2


def tiles(x: np.ndarray, octave: int, bounds: np.ndarray, periods: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first word, words, boundaries, periods) of the tiles that hold a boundary; positions are relative to the first word.

    A tile owns ``max(TILE, 8 Q)`` words of boundaries and sees Q words before and 5 Q after them: the
    first boundary of a run is less than Q after its start, the last one less than 3 Q before the last
    word that has an equal one q on, which is less than 2 Q away."""
    width = max(TILE, 8 * octave)
    place = bounds // width
    cut = np.flatnonzero(np.diff(place)) + 1
    for p, b, q in zip(np.split(place, cut), np.split(bounds, cut), np.split(periods, cut)):
        first = max(0, int(p[0]) * width - octave)
        last = min(len(x), (int(p[0]) + 1) * width + 5 * octave)
        yield first, x[first:last], b - first, q


def z_function(s: list, upto: int) -> list[int]:
    """How many items of ``s[i:]`` equal ``s``'s first ones, for i < ``upto``."""
    n = len(s)
    upto = min(upto, n)
    z = [0] * upto
    if upto:
        z[0] = n
    left = right = 0
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def solve(x: list[int], octave: int, bounds: list[int], periods: list[int]) -> list[tuple[int, int, int]]:
    """Fragments (period, start, end): the stretches of i with x[i] == x[i + period] around the boundaries."""
    out: list[tuple[int, int, int]] = []
    seen: dict[int, int] = {}  # period -> end of its last fragment
    i = 0
    while i < len(bounds):
        b, open_ = bounds[i], []
        while i < len(bounds) and bounds[i] == b:
            if seen.get(periods[i], -1) <= b:
                open_.append(periods[i])
            i += 1
        if not open_:
            continue
        after = z_function(x[b:], 2 * octave)
        open_ = [q for q in open_ if q < len(after) and after[q] >= 2 * octave]
        if not open_:
            continue  # equal hashes of different blocks
        # the longest common ends of x[:b] and x[:b + q]: a mark that equals nothing keeps the parts apart
        before = z_function([*x[:b][::-1], None, *x[: b + 2 * octave][::-1]], b + 1 + 2 * octave)
        have = min(len(x), b + 2 * octave) - b
        for q in open_:
            start, end = b - before[b + 1 + have - q], b + after[q]
            out.append((q, start, end))
            seen[q] = end
    return out


def _narrow(x: np.ndarray) -> bytes:
    """Numbers from 0 on, in two bytes each where they fit; the first byte tells the width."""
    width = 2 if not len(x) or x.max() < 1 << 16 else 4
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1)


_SCAN = columns(
    "rid long, doc_id long, n long, words binary, plain_sha256 string, "
    "octave int, first long, ids binary, bounds binary, periods binary"
)


def _scan(docs: DataFrame) -> DataFrame:
    """One row per document (octave null) and one per tile (n null)."""
    bound_batches(docs.sparkSession)

    def rows_of(rids, ids, texts, powers):
        words = [impose(i, split_words(t)) for i, t in zip(ids, texts)]
        table: dict[bytes, int] = {}
        number = table.setdefault
        x = [np.fromiter((number(w, len(table)) for w in ws), np.int32, len(ws)) for ws in words]
        out, tiled = [], set()
        for d, octave, b, q in equal_blocks(x, powers):
            tiled.add(d)
            for first, part, bs, qs in tiles(x[d], octave, b, q):
                blobs = [_narrow(a) for a in (part, bs, qs)]
                out.append((rids[d], None, None, None, None, octave, first, *blobs))
        for d, ws in enumerate(words):
            text = b" ".join(ws)
            kept = (zlib.compress(text, 1), None) if d in tiled else (None, hashlib.sha256(text).hexdigest())
            out.append((rids[d], ids[d], len(ws), *kept, None, None, None, None, None))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, powers = to_arrow_schema(_SCAN), _Powers()
        for batch in batches:
            rids, ids, texts = (batch.column(i).to_pylist() for i in range(3))
            at = 0
            while at < len(rids):
                to, size = at, 0
                while to < len(rids) and (to == at or size + len(texts[to] or "") <= SLICE_BYTES):
                    size += len(texts[to] or "")
                    to += 1
                got = rows_of(rids[at:to], ids[at:to], texts[at:to], powers)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got), schema)], schema=schema)
                at = to

    read = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return read.mapInArrow(run, _SCAN)


def _fragments(tiled: DataFrame) -> DataFrame:
    """(rid, period, start, end) of every tile, in words of the document."""
    schema = columns("rid long, period long, start long, end long")

    def make():
        def fn(c):
            out = []
            for rid, octave, first, *blobs in zip(*(c[k] for k in ("rid", "octave", "first", "ids", "bounds", "periods"))):
                x, b, q = (_wide(v).tolist() for v in blobs)
                out += [(rid, p, first + s, first + e) for p, s, e in solve(x, octave, b, q)]
            return {k: list(v) for k, v in zip(schema.names, zip(*out))} if out else None

        return fn

    return map_slices(tiled, make, schema)


def _stitched(fragments: DataFrame) -> DataFrame:
    """(rid, start, length, period) of the runs: overlapping fragments of a document and period are one stretch."""
    order = Window.partitionBy("rid", "period").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.coalesce((F.col("start") > F.col("reach")).cast("int"), F.lit(1))).over(order)
    whole = (
        fragments.withColumn("reach", reach)
        .withColumn("island", island)
        .groupBy("rid", "period", "island")
        .agg(F.min("start").alias("start"), (F.max("end") - F.min("start") + F.col("period")).alias("length"))
        .where(F.col("length") >= F.greatest(F.lit(LEAST_LENGTH), LEAST_EXPONENT * F.col("period")))
    )
    return whole.groupBy("rid", "start", "length").agg(F.min("period").alias("period"))


def runs_by_document(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, runs): a row (rid, doc_id, n, words, plain_sha256) per document, ``words`` only where a
    run is possible, and (rid, start, length, period) per run."""
    spark = docs.sparkSession
    path = scratch_path(spark, "periodic-tiles")
    _scan(docs).write.parquet(path)
    scanned = spark.read.schema(_SCAN).parquet(path)
    tiled = scanned.where(F.col("octave").isNotNull()).drop("doc_id", "n", "words", "plain_sha256")
    # by document, octave and place: the tiles of a long document go to many tasks
    fragments = _fragments(tiled.repartition("rid", "octave", "first"))
    texts = scanned.where(F.col("octave").isNull()).select("rid", "doc_id", "n", "words", "plain_sha256")
    return texts, _stitched(fragments)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words in no run but its first period, joined by one space; ``runs`` are (start, length, period)."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([w for w, k in zip(words, kept.tolist()) if k])


OUT = columns(
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, n_words long"
)


def detect(docs: DataFrame) -> DataFrame:
    """The runs of every document in short (``OUT``): their number, the longest one, and hashes of the list
    of runs and of the words left when a run keeps its first period only."""
    texts, runs = runs_by_document(docs)
    best = F.max(F.struct("length", -F.col("start"), -F.col("period"))).alias("best")
    listed = F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    by_doc = runs.groupBy("rid").agg(listed, best)

    def make():
        def fn(c):
            out = {f: [] for f in OUT.names}
            for doc_id, n, words, plain, found, top in zip(*(c[k] for k in ("doc_id", "n", "words", "plain_sha256", "runs", "best"))):
                spans = [(r["start"], r["length"], r["period"]) for r in found or ()]
                start, length, period = (-top["s"], top["length"], -top["p"]) if top else (None, None, None)
                if words is not None:
                    plain = hashlib.sha256(_collapsed(zlib.decompress(words).split(), spans)).hexdigest()
                listing = "".join(f"{s},{k},{p}\n" for s, k, p in spans)
                row = (
                    doc_id, len(spans), start, length, period, 1000 * length // period if top else None,
                    hashlib.sha256(listing.encode()).hexdigest() if spans else NONE, plain, n,
                )
                for f, v in zip(OUT.names, row):
                    out[f].append(v)
            return out

        return fn

    best_named = F.col("best").cast("struct<length:long,s:long,p:long>").alias("best")
    met = texts.join(by_doc, "rid", "left").select("doc_id", "n", "words", "plain_sha256", "runs", best_named)
    return map_slices(met, make, OUT)
