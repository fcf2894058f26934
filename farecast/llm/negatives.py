"""Hard negatives (12): windows of scores, read from Hilbert-ordered blocks behind zone maps.

1. Rows are dealt out by ranges of a Hilbert curve over the dimensions of
   largest variance and written as Parquet blocks of ``BLOCK`` neighbouring
   rows, each with a zone map: the least and largest value of every dimension
   and the labels it holds.
2. Anchors are taken from the blocks in curve order, in groups of ``GROUP``.
   The anchor's own block gives a first bound on its positives and
   negatives at once: the scores its neighbours reach there.
3. Interval arithmetic over a zone map bounds the scores of a block for an
   anchor from both sides. A block is read for a group if, for one of its
   anchors, the bounds leave a chance for a score the anchor still wants: a
   same-label one no worse than the best five known, or a different-label one
   in a window of one of its positives.
4. Chosen blocks meet the group in slices of ``SLICE`` blocks; a slice is one
   matrix product and keeps the few best rows per anchor (or window), which
   a window function then ranks over the slices.

Steps 3 and 4 run twice, for positives and then for the windows they open.
Nothing is collected; zone maps, anchors and blocks are met by key, in chunks
of bounded size, so no side needs to fit anywhere whole. Every row that a
bound does not rule out is scored exactly: recall is 1.

Scores are exact: products of whole numbers are summed in floating point
only where no sum can leave its exact range, else in Python integers (and
scores beyond 2**62 are kept there).

Nulls: rows with a null id, label or vector, or a component that is null or
not finite, take no part. Rows of different dimension are never compared;
empty vectors score 0 with each other. Repeated rows are rows of their own
(the twin of an anchor is another row). Empty tables give no rows. Other
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farecast.llm.common import bound_batches, columns
from farecast.session import scratch_path

BLOCK = 512  # rows of a block
SLICE = 32  # blocks scored together
GROUP = 512  # anchors of a group
ZONES, GROUPS = 1024, 64  # zone maps and anchor groups that meet at once
CURVE_DIMS, CURVE_BITS = 7, 9  # 63 bits
POSITIVES, NEGATIVES = 5, 3
SCALE = 256
LOW, HIGH = 50, 95  # percent of the positive's score
EVERY = 50  # ids divisible by it are anchors

_LEAST, _MOST = -(1 << 62), 1 << 62


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid cells (rows, dims), dims * bits <= 63.

    The transposed-bits form: undo the excess rotations from the high bit down, Gray-encode, then interleave."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[n - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows, as int64 (kept within 2**62 of zero)."""
    if not a.shape[1] or not len(a) or not len(c):
        return np.zeros((len(a), len(c)), np.int64)
    reach = float(np.abs(a).max()) * float(np.abs(c).max()) * a.shape[1]
    if reach < 1 << 24:
        return (a.astype(np.float32) @ c.astype(np.float32).T).astype(np.int64)
    if reach < 1 << 53:
        return (a.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    whole = np.array([[int(v) for v in row] for row in a], object) @ np.array([[int(v) for v in row] for row in c], object).T
    return np.array([[min(max(int(v), _LEAST), _MOST) for v in row] for row in whole], np.int64)


def score_bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, blocks) least and largest possible scores: each component takes the end of the
    block's interval that its sign asks for. Widened by what floating point may lose."""
    up, down = np.maximum(a, 0).astype(np.float64), np.minimum(a, 0).astype(np.float64)
    low, high = low.astype(np.float64), high.astype(np.float64)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    span = np.maximum(np.abs(low), np.abs(high)).max(1, initial=0.0)
    slack = np.abs(a).astype(np.float64).sum(1)[:, None] * span * 1e-12
    return least - slack, most + slack


def window_of(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest whole scores n with LOW * p <= 100 * n <= HIGH * p; empty (least > largest) for p < 0."""
    p = positive.astype(object)
    least, most = np.array([-(-LOW * v // 100) for v in p.flat], object), np.array([HIGH * v // 100 for v in p.flat], object)
    return (least.reshape(p.shape).astype(np.int64), most.reshape(p.shape).astype(np.int64))


def _pack(x: np.ndarray) -> bytes:
    """Whole-number rows as 16-bit integers where they fit, else as doubles (exact for any scaled float)."""
    small = not x.size or np.abs(x).max() < 1 << 15
    return (b"h" + x.astype("<i2").tobytes()) if small else (b"d" + x.astype("<f8").tobytes())


def _unpack(raw: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<i2" if raw[:1] == b"h" else "<f8", offset=1).reshape(n, dim)


def _long(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


_RAW = columns("vec_id long, label long, dim int, place long, vector binary")
_BLOCKS = columns("block long, dim int, n int, low binary, high binary, labels binary, ids binary, row_labels binary, vectors binary")
_GROUPS = columns("grp long, dim int, n int, rows binary, ids binary, row_labels binary, vectors binary, known binary")


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, embedding of doubles) of the rows that take part, with the label moved on for every seventh id."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").where(
        known
    ).select("vec_id", label.alias("label"), x.alias("embedding"))


def _rows_of(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(v, np.float64) for v in column.to_pylist()]


def _spread(vectors: DataFrame) -> dict[int, list[tuple[int, float, float]]]:
    """Per dimension count: the CURVE_DIMS dimensions of largest variance with their (mean, deviation).

    Tasks add up their own rows; one row per task and dimension count is merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for v in _rows_of(batch.column(0)):
                v = np.clip(v, -1e100, 1e100)
                s = sums.setdefault(len(v), np.zeros((3, len(v))))
                s += np.stack([np.ones(len(v)), v, v * v])
        for dim, s in sums.items():
            cols = [np.full(dim, dim, np.int32), np.arange(dim, dtype=np.int32), *s]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["dim", "at", "n", "total", "squares"])

    got = (
        vectors.select("embedding").mapInArrow(run, "dim int, at int, n double, total double, squares double")
        .groupBy("dim", "at").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])
        .withColumn("mean", F.col("total") / F.col("n"))
        .withColumn("variance", F.greatest(F.col("squares") / F.col("n") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    )
    top = Window.partitionBy("dim").orderBy(F.desc("variance"), "at")
    rows = got.withColumn("r", F.row_number().over(top)).where(F.col("r") <= CURVE_DIMS).collect()
    out: dict[int, list[tuple[int, float, float]]] = {}
    for r in sorted(rows, key=lambda r: (r["dim"], r["r"])):
        out.setdefault(r["dim"], []).append((r["at"], r["mean"], max(r["variance"] ** 0.5, 1e-300)))
    return out


def _placed(vectors: DataFrame, spread: dict[int, list[tuple[int, float, float]]]) -> DataFrame:
    """``_RAW`` rows: the vector scaled to whole numbers, and its place on the curve (cells of an even
    grid over three deviations to both sides of the mean)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist(), _rows_of(batch.column(2))
            places = np.zeros(len(rows), np.int64)
            for dim in {len(v) for v in rows} & spread.keys():
                at = [i for i, v in enumerate(rows) if len(v) == dim]
                x = np.stack([rows[i] for i in at])
                unit = np.stack([(x[:, j] - m) / (6 * s) + 0.5 for j, m, s in spread[dim]], 1)
                cells = np.clip(np.nan_to_num(unit) * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.int64)
                places[at] = hilbert(cells, CURVE_BITS)
            whole = [np.floor(SCALE * v) for v in rows]
            cols = [ids, labels, [len(v) for v in rows], places, [_pack(v) for v in whole]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                names=_RAW.names,
            )

    return vectors.mapInArrow(run, _RAW)


def _batch(schema, rows: list[tuple]) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    cols = zip(*rows) if rows else [()] * len(arrow)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)


def _blocks(placed: DataFrame) -> DataFrame:
    """Rows in curve order, cut into blocks within their task; a block's id names its task and place there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []

        def block():
            nonlocal number
            dim, n = held[0][2], len(held)
            ids, labels = (np.array([h[k] for h in held], "<i8") for k in (0, 1))
            x = np.stack([_unpack(h[4], dim, 1)[0].astype(np.float64) for h in held])
            zone = [_pack(x.min(0)), _pack(x.max(0)), np.unique(labels).tobytes()]
            row = (task | number, dim, n, *zone, ids.tobytes(), labels.tobytes(), _pack(x))
            number += 1
            held.clear()
            return _batch(_BLOCKS, [row])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (len(held) == BLOCK or held[0][2] != row[2]):
                    yield block()
                held.append(row)
        if held:
            yield block()

    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["dim", "place", "vec_id"]
    return placed.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(run, _BLOCKS)


def _groups(blocks: DataFrame) -> DataFrame:
    """Anchors in curve order, up to GROUP of them; ``known`` is the POSITIVES-th best score of a same-label
    neighbour in the anchor's own block (no bound where it has fewer)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []
        size = 0

        def group():
            nonlocal number, size
            dim = held[0][0]
            rows, ids, labels, known = (np.concatenate([h[k] for h in held]).astype("<i8") for k in (1, 2, 3, 5))
            out = (task | number, dim, len(ids), *(a.tobytes() for a in (rows, ids, labels)))
            out = (*out, _pack(np.concatenate([h[4] for h in held])), known.tobytes())
            number += 1
            size = 0
            held.clear()
            return _batch(_GROUPS, [out])

        for batch in batches:
            for b, dim, n, ids, labels, vectors in zip(*(c.to_pylist() for c in batch.columns)):
                ids, labels, x = _long(ids), _long(labels), _unpack(vectors, dim, n)
                at = np.flatnonzero(ids % EVERY == 0)
                if not len(at):
                    continue
                if held and (held[0][0] != dim or size + len(at) > GROUP):
                    yield group()
                got = scores(x[at], x)
                got[labels[at][:, None] != labels] = _LEAST
                got[np.arange(len(at)), at] = _LEAST
                known = np.sort(got, 1)[:, -POSITIVES] if n > POSITIVES else np.full(len(at), _LEAST)
                held.append((dim, (b << 10) + at, ids[at], labels[at], x[at].astype(np.float64), known))
                size += len(at)
        if held:
            yield group()

    return blocks.select("block", "dim", "n", "ids", "row_labels", "vectors").mapInArrow(run, _GROUPS)


_WANTED = columns("grp long, dim int, n int, rows binary, ids binary, row_labels binary, vectors binary, least binary, most binary")


def _chosen(wanted: DataFrame, blocks: DataFrame, same_label: bool) -> DataFrame:
    """(grp, block, slice) of the blocks whose zone maps leave a chance for a score wanted by an anchor of the group.

    ``least`` and ``most`` of a group are its anchors' windows (anchors, windows per anchor). About ZONES
    zone maps meet about GROUPS groups at once: both sides are cut into parts by a hash, and each is dealt
    to the keys (part of zones, part of groups) it belongs to."""
    zones = blocks.select("block", "dim", "low", "high", "labels")
    groups = wanted.select("grp", "dim", "n", "row_labels", "vectors", "least", "most")
    z_parts, g_parts = max(1, -(-zones.count() // ZONES)), max(1, -(-groups.count() // GROUPS))

    def every(parts: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    zones = zones.withColumn("z", F.pmod(F.xxhash64("block"), F.lit(z_parts))).withColumn("g", every(g_parts))
    groups = groups.withColumn("g", F.pmod(F.xxhash64("grp"), F.lit(g_parts))).withColumn("z", every(z_parts))
    out = columns("grp long, block long, slice long")

    def choose(left: Iterator[pa.RecordBatch], right: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, list] = {}
        for batch in right:
            for b, dim, low, high, labels in zip(*(batch.column(c).to_pylist() for c in ("block", "dim", "low", "high", "labels"))):
                maps.setdefault(dim, []).append((b, _unpack(low, dim, 1)[0], _unpack(high, dim, 1)[0], _long(labels)))
        ready = {d: (np.array([m[0] for m in v]), *(np.stack([m[k] for m in v]) for k in (1, 2)), [m[3] for m in v]) for d, v in maps.items()}
        for batch in left:
            for g, dim, n, labels, vectors, least, most in zip(
                *(batch.column(c).to_pylist() for c in ("grp", "dim", "n", "row_labels", "vectors", "least", "most"))
            ):
                if dim not in ready:
                    continue
                ids, low, high, held = ready[dim]
                labels, x = _long(labels), _unpack(vectors, dim, n)
                lo, hi = _long(least).reshape(n, -1), _long(most).reshape(n, -1)
                below, above = score_bounds(x, low, high)
                kinds, at = np.unique(labels, return_inverse=True)
                has = np.array([[bool(np.isin(k, h)) if same_label else bool((h != k).any()) for h in held] for k in kinds])
                need = np.zeros((n, len(ids)), bool)
                for w in range(lo.shape[1]):
                    need |= (above >= lo[:, w, None]) & (below <= hi[:, w, None]) & (lo[:, w] <= hi[:, w])[:, None]
                got = ids[(need & has[at]).any(0)]
                if len(got):
                    yield _batch(out, [(g, int(b), (int(b) >> 32 << 32) | ((int(b) & 0xFFFFFFFF) // SLICE)) for b in got])

    return groups.groupBy("z", "g").cogroup(zones.groupBy("z", "g")).applyInArrow(_cogrouped(choose, out), out)


def _cogrouped(fn, schema):
    """``fn(left batches, right batches) -> batches`` as a cogroup function over tables."""
    from pyspark.sql.pandas.types import to_arrow_schema

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches(fn(iter(left.to_batches()), iter(right.to_batches())), to_arrow_schema(schema))

    return run


_HITS = columns("grp long, anchor long, w int, vec_id long, score long, rank_row long")


def _hits(wanted: DataFrame, blocks: DataFrame, same_label: bool, top: int) -> DataFrame:
    """(grp, anchor row, window, vec_id, score): per anchor and window the ``top`` best rows of its label
    (or of others), higher scores first, ties by smaller id."""
    spark = blocks.sparkSession
    path = scratch_path(spark, "negatives-chosen")
    chosen = _chosen(wanted, blocks, same_label)
    chosen.write.parquet(path)
    chosen, slices = (spark.read.schema(chosen.schema).parquet(path) for _ in range(2))
    read = chosen.join(blocks.select("block", "dim", "n", "ids", "row_labels", "vectors"), "block")
    met = slices.select("grp", "slice").distinct().join(wanted, "grp")

    def score(left: Iterator[pa.RecordBatch], right: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [
            (b, _long(ids), _long(labels), _unpack(v, dim, n))
            for batch in right
            for b, dim, n, ids, labels, v in zip(*(batch.column(c).to_pylist() for c in ("block", "dim", "n", "ids", "row_labels", "vectors")))
        ]
        rows = np.concatenate([(b << 10) + np.arange(len(i)) for b, i, _, _ in held])
        ids, labels = (np.concatenate([h[k] for h in held]) for k in (1, 2))
        order = np.lexsort((rows, ids))
        rows, ids, labels = rows[order], ids[order], labels[order]
        x = np.concatenate([h[3] for h in held])[order]
        for batch in left:
            for g, dim, n, own, anchor_labels, vectors, least, most in zip(
                *(batch.column(c).to_pylist() for c in ("grp", "dim", "n", "rows", "row_labels", "vectors", "least", "most"))
            ):
                own, anchor_labels, a = _long(own), _long(anchor_labels), _unpack(vectors, dim, n)
                lo, hi = _long(least).reshape(n, -1), _long(most).reshape(n, -1)
                for at in range(0, n, 64):
                    part = slice(at, min(n, at + 64))
                    got = scores(a[part], x)
                    same = anchor_labels[part][:, None] == labels
                    open_ = (same if same_label else ~same) & (own[part][:, None] != rows)
                    wide = lo[part] <= hi[part]
                    floor = np.where(wide, lo[part], _MOST + 1).min(1)
                    ceiling = np.where(wide, hi[part], _LEAST - 1).max(1)
                    open_ &= (got >= floor[:, None]) & (got <= ceiling[:, None])
                    r, c = np.nonzero(open_)
                    s = got[r, c]
                    by = np.lexsort((c, -s, r))
                    r, c, s = r[by], c[by], s[by]
                    ends = np.searchsorted(r, np.arange(part.stop - part.start + 1))
                    out = []
                    for i in range(part.stop - part.start):
                        mine = -s[ends[i] : ends[i + 1]]
                        for w in range(lo.shape[1]):
                            l, h = lo[at + i, w], hi[at + i, w]
                            if l > h or not len(mine):
                                continue
                            first = int(np.searchsorted(mine, -h))
                            for k in range(first, min(first + top, int(np.searchsorted(mine, -l, side="right")))):
                                j = c[ends[i] + k]
                                out.append((g, int(own[at + i]), w, int(ids[j]), int(-mine[k]), int(rows[j])))
                    if out:
                        yield _batch(_HITS, out)

    hits = met.groupBy("grp", "slice").cogroup(read.groupBy("grp", "slice")).applyInArrow(_cogrouped(score, _HITS), _HITS)
    best = Window.partitionBy("grp", "anchor", "w").orderBy(F.desc("score"), "vec_id", "rank_row")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).drop("rank_row")


def _open(groups: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """``_WANTED`` rows. Without windows: one per anchor, from what its own block showed upwards; with
    (grp, anchor, w, score) of the positives: theirs."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, dim, n, rows, ids, labels, vectors, known in zip(*(c.to_pylist() for c in batch.columns)):
                most = np.full(n, _MOST, "<i8").tobytes()
                yield _batch(_WANTED, [(g, dim, n, rows, ids, labels, vectors, known, most)])

    if windows is None:
        return groups.mapInArrow(first, _WANTED)

    def second(left: Iterator[pa.RecordBatch], right: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for batch in right for r in zip(*(batch.column(c).to_pylist() for c in ("anchor", "w", "score")))]
        for batch in left:
            for g, dim, n, rows, ids, labels, vectors, _ in zip(*(batch.column(c).to_pylist() for c in _GROUPS.names)):
                at = {int(r): i for i, r in enumerate(_long(rows))}
                lo, hi = np.full((n, POSITIVES), 1, "<i8"), np.zeros((n, POSITIVES), "<i8")
                if got:
                    i, w = [at[a] for a, _, _ in got], [w for _, w, _ in got]
                    lo[i, w], hi[i, w] = window_of(np.array([s for *_, s in got], np.int64))
                yield _batch(_WANTED, [(g, dim, n, rows, ids, labels, vectors, lo.tobytes(), hi.tobytes())])

    return groups.groupBy("grp").cogroup(windows.select("grp", "anchor", "w", "score").groupBy("grp")).applyInArrow(
        _cogrouped(second, _WANTED), _WANTED
    )


class Index:
    """Blocks and anchor groups of one table, in the shared folder."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        bound_batches(spark)
        vectors = usable(rows)
        self.spark = spark
        self.blocks = self._kept(_blocks(_placed(vectors, _spread(vectors))), "negatives-blocks")
        self.groups = self._kept(_groups(self.blocks), "negatives-groups")

    def _kept(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def positives(self) -> DataFrame:
        """(grp, anchor, w, vec_id, score): each anchor's POSITIVES best rows of its label, w from 0."""
        best = _hits(_open(self.groups), self.blocks, True, POSITIVES)
        return self._kept(best.withColumn("w", (F.col("rank") - 1).cast("int")).drop("rank"), "negatives-positives")

    def negatives(self, positives: DataFrame) -> DataFrame:
        """(grp, anchor, w, vec_id, score, rank): the NEGATIVES best rows of other labels in each positive's window."""
        return _hits(self._kept(_open(self.groups, positives), "negatives-windows"), self.blocks, False, NEGATIVES)


OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mine(rows: DataFrame) -> DataFrame:
    """``OUT`` rows: for each anchor and positive the best different-label rows in the window of scores."""
    index = Index(rows)
    positives = index.positives()
    hits = index.negatives(positives).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    pairs = positives.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"})

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = columns("anchor long, anchor_id long")
        for batch in batches:
            for raw, ids in zip(*(c.to_pylist() for c in batch.columns)):
                yield _batch(schema, list(zip(_long(raw).tolist(), _long(ids).tolist())))

    anchors = index.groups.select("rows", "ids").mapInArrow(names, "anchor long, anchor_id long")
    met = hits.join(pairs, ["grp", "anchor", "w"]).join(anchors, "anchor")
    return met.withColumn("rank", F.col("rank").cast("int")).select(*OUT)
