"""Random forest regression on a bounded sample, one tree a task (L2, L3).

The train rows of a run are a bounded sample (``fit_rows``), so a tree needs
no distributed passes over the data: every task gets the whole sample, draws
its tree's bootstrap and grows the tree until its leaves are pure. Trees are
independent, so they spread over the cluster and a lost executor costs the
trees it was growing. The settings are the original model's: exact splits on
all features, no depth limit, rows drawn with replacement.

A tree is four flat arrays. The nodes of a forest are at most twice the
sample's rows times the trees, which bounds what is saved, loaded and sent to
the scoring tasks.

Scoring looks at every distinct combination of feature values once: the
distinct rows are predicted in numpy and written to the shared folder, then
joined to the rows that have them (Catalyst broadcasts them by their written
size). Rows themselves never pass through Python. Distinct rows are dealt and
sorted by all features but the one with the most thresholds (the axis): where
the others are given, a tree is a step function of the axis, which is walked
once for all the rows that share them, and a row is one binary search in it.

Null and NaN features are larger than any number, in training and scoring.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.session import scratch_path, ship_code

TREES = T.StructType(
    [
        T.StructField("tree", T.LongType()),
        *[T.StructField(n, T.BinaryType()) for n in ("feature", "threshold", "left", "value")],
    ]
)


SLICE_ROWS = 200_000  # distinct rows are predicted so many at a time
ROWS_A_WALK = 16  # with fewer rows for each combination of the other features, rows go down the trees one by one


@dataclass
class Tree:
    """Per node: feature (-1: leaf), threshold (larger goes right), left child (right is the next node), value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def row(self, number: int) -> tuple:
        return (
            number, self.feature.astype("<i2").tobytes(), self.threshold.astype("<f8").tobytes(),
            self.left.astype("<i4").tobytes(), self.value.astype("<f8").tobytes(),
        )

    @staticmethod
    def of(row) -> "Tree":
        return Tree(*(np.frombuffer(row[n], t) for n, t in (("feature", "<i2"), ("threshold", "<f8"), ("left", "<i4"), ("value", "<f8"))))

    def predict(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            at = node[rows]
            f = self.feature[at]
            rows, at, f = rows[f >= 0], at[f >= 0], f[f >= 0]
            node[rows] = self.left[at] + (x[rows, f] > self.threshold[at])
        return self.value[node]


def _joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches in tables of at least ``rows`` rows, but for the last."""
    kept, size = [], 0
    for batch in batches:
        kept.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(kept)
            kept, size = [], 0
    if size:
        yield pa.Table.from_batches(kept)


def _splits(codes: np.ndarray, size: int, at: np.ndarray, k: int, w: np.ndarray, r: np.ndarray, total: np.ndarray):
    """Best cut of every node on one feature: (gain, code left of the cut, code right of it); gain -1 without one.

    ``r`` holds the rows' weighted distances from their node's mean, which sum to 0 in a node."""
    key = at * size + codes
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    cell = key[starts]
    node = cell // size
    weight, pull = np.cumsum(np.add.reduceat(w[order], starts)), np.cumsum(np.add.reduceat(r[order], starts))
    first = np.searchsorted(node, np.arange(k))
    before = np.concatenate([[0.0], weight])[first], np.concatenate([[0.0], pull])[first]
    i = np.flatnonzero(node[1:] == node[:-1])
    n = node[i]
    wl, sl = weight[i] - before[0][n], pull[i] - before[1][n]
    gain = sl * sl * (1 / wl + 1 / (total[n] - wl))
    best = np.lexsort((-gain, n))
    best = best[np.concatenate([[True], n[best][1:] != n[best][:-1]])] if len(best) else best
    out = np.full(k, -1.0), np.zeros(k, np.int64), np.zeros(k, np.int64)
    out[0][n[best]] = gain[best]
    out[1][n[best]], out[2][n[best]] = cell[i[best]] % size, cell[i[best] + 1] % size
    return out


def grow(codes: np.ndarray, values: list[np.ndarray], y: np.ndarray, w: np.ndarray, max_depth: int | None = None) -> Tree:
    """One regression tree, level by level: every impure node takes the cut that lowers its squared error
    most (ties: the first feature, the smallest value), until leaves are pure or their rows are all alike.

    ``codes`` are each feature's ranks among its sorted ``values``; ``w`` how often a row counts."""
    feature, threshold, left, value = [], [], [], []
    rows = np.flatnonzero(w > 0)
    at, nodes = np.zeros(len(rows), np.int64), 1 if len(rows) else 0
    if not nodes:
        return Tree(np.array([-1]), np.zeros(1), np.zeros(1, np.int64), np.zeros(1))
    spread = float(np.average((y[rows] - np.average(y[rows], weights=w[rows])) ** 2, weights=w[rows]))
    level = start = 0
    while nodes:
        total = np.bincount(at, w[rows], nodes)
        mean = np.bincount(at, w[rows] * y[rows], nodes) / total
        r = w[rows] * (y[rows] - mean[at])
        impure = np.bincount(at, r * (y[rows] - mean[at]), nodes) > 1e-12 * spread * total
        if max_depth is not None and level >= max_depth:
            impure[:] = False
        gain, which = np.full(nodes, -1.0), np.full(nodes, -1)
        low, high = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        live = impure[at]
        rows, at, r = rows[live], at[live], r[live]
        if len(rows):
            for j, v in enumerate(values):
                if len(v) < 2:
                    continue
                g, a, b = _splits(codes[rows, j], len(v), at, nodes, w[rows], r, total)
                better = g > gain + 1e-12 * spread
                gain[better], which[better], low[better], high[better] = g[better], j, a[better], b[better]
        split = which >= 0
        child = np.cumsum(split) - 1  # number of each split among the level's
        cut = np.zeros(nodes)
        for j, v in enumerate(values):
            on = which == j
            lo, hi = v[low[on]], v[high[on]]
            with np.errstate(invalid="ignore"):
                cut[on] = np.where(np.isinf(hi), lo, lo + (hi - lo) / 2)
        feature.append(which), threshold.append(cut), value.append(mean)
        left.append(np.where(split, start + nodes + 2 * child, 0))
        keep = split[at]
        rows, at = rows[keep], at[keep]
        at = 2 * child[at] + (codes[rows, which[at]] > low[at])
        start += nodes
        nodes = 2 * int(split.sum())
        level += 1
    return Tree(*(np.concatenate(a) for a in (feature, threshold, left, value)))


def _plain(columns: Sequence[pa.Array]) -> np.ndarray:
    """Feature columns as doubles (rows, features); null and NaN become infinite."""
    cols = []
    for c in columns:
        c = c.cast(pa.int8()) if pa.types.is_boolean(c.type) else c
        x = c.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False).astype(np.float64)
        cols.append(np.where(np.isnan(x), np.inf, x))
    return np.stack(cols, 1)


def _steps(tree: Tree, axis: int, cuts: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tree as step functions of the feature ``axis``, one for each row of ``given`` (the other features).

    ``cuts`` are the sorted thresholds on the axis; a value's code is the number of cuts below it. A step is
    (row of ``given`` * (cuts + 1) + first code, value); steps come sorted."""
    size = len(cuts) + 1
    place = np.searchsorted(cuts, tree.threshold)
    row, node = np.arange(len(given)), np.zeros(len(given), np.int64)
    first, last = np.zeros(len(given), np.int64), np.full(len(given), len(cuts))
    keys, values = [], []
    while len(node):
        f = tree.feature[node]
        leaf = f < 0
        keys.append(row[leaf] * size + first[leaf]), values.append(tree.value[node[leaf]])
        row, node, first, last, f = row[~leaf], node[~leaf], first[~leaf], last[~leaf], f[~leaf]
        cut, on = place[node], f == axis
        larger = given[row, f] > tree.threshold[node]
        low = np.where(on, first <= cut, ~larger)
        high = np.where(on, last > cut, larger)
        child = tree.left[node].astype(np.int64)
        node = np.concatenate([child[low], child[high] + 1])
        first, last = (
            np.concatenate([first[low], np.where(on, np.maximum(first, cut + 1), first)[high]]),
            np.concatenate([np.where(on, np.minimum(last, cut), last)[low], last[high]]),
        )
        row = np.concatenate([row[low], row[high]])
    keys, values = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(keys)
    return keys[order], values[order]


def _alike(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row's place for each group of equal rows, each row's group)."""
    group = np.zeros(len(x), np.int64)
    for j in range(x.shape[1]):
        seen, code = np.unique(x[:, j], return_inverse=True)
        group = np.unique(group * len(seen) + code, return_inverse=True)[1]
    return np.unique(group, return_index=True)[1], group


@dataclass
class Forest:
    features: list[str]
    trees: list[Tree]

    def axis(self) -> tuple[int, np.ndarray]:
        """The feature with the most thresholds, and those, sorted."""
        cuts = [
            np.unique(np.concatenate([t.threshold[t.feature == j] for t in self.trees])) for j in range(len(self.features))
        ]
        most = int(np.argmax([len(c) for c in cuts]))
        return most, cuts[most]

    def predict(self, x: np.ndarray, axis: tuple[int, np.ndarray] | None = None) -> np.ndarray:
        """The mean of the trees, added up in their order either way."""
        if axis and len(x):
            at, cuts = axis
            some, group = _alike(np.delete(x, at, 1))
            if ROWS_A_WALK * len(some) <= len(x):
                key, back = np.unique(group * (len(cuts) + 1) + np.searchsorted(cuts, x[:, at]), return_inverse=True)
                total = np.zeros(len(key))
                for t in self.trees:
                    keys, values = _steps(t, at, cuts, x[some])
                    total += values[np.searchsorted(keys, key, "right") - 1]
                return (total / len(self.trees))[back]
        return sum((t.predict(x) for t in self.trees), np.zeros(len(x))) / len(self.trees)

    @property
    def nodes(self) -> int:
        return sum(len(t.feature) for t in self.trees)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``: every distinct combination of feature values is predicted once."""
        spark = df.sparkSession
        ship_code(spark)
        names = [f"__f{i}" for i in range(len(self.features))]
        distinct = df.select(*[F.col(f).alias(n) for f, n in zip(self.features, names)]).distinct()
        axis = self.axis()
        if others := [n for i, n in enumerate(names) if i != axis[0]]:
            distinct = distinct.repartition(*others).sortWithinPartitions(*others)
        schema = T.StructType([*distinct.schema.fields, T.StructField("prediction", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _joined(batches, SLICE_ROWS):
                columns = [c.combine_chunks() for c in part.columns]
                got = pa.array(self.predict(_plain(columns), axis))
                yield from pa.Table.from_arrays([*columns, got], names=[*names, "prediction"]).to_batches()

        path = scratch_path(spark, "predicted")
        distinct.mapInArrow(run, schema).write.parquet(path)
        cells = spark.read.schema(schema).parquet(path)
        on = reduce(lambda a, b: a & b, [df[f].eqNullSafe(cells[n]) for f, n in zip(self.features, names)])
        return df.join(cells, on, "left").drop(*names)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [t.row(i) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, TREES).write.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(self.features,)], "features array<string>").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/features"
        )

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Forest":
        features = list(spark.read.parquet(f"{path}/features").first()["features"])
        rows = sorted(spark.read.schema(TREES).parquet(f"{path}/trees").collect(), key=lambda r: r["tree"])
        return Forest(features, [Tree.of(r) for r in rows])


def sample_arrays(sample: DataFrame, features: Sequence[str], label: str, weight: str | None, key: Sequence[str]):
    """(features, labels, weights) of a frame of bounded size, in the order of ``key``."""
    cols = [*features, F.col(label).cast("double").alias("__y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("__w")]
    got = sample.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], *cols).toArrow()
    got = got.sort_by([(f"__k{i}", "ascending") for i in range(len(key))]).combine_chunks()
    x = _plain([got.column(f).combine_chunks() for f in features]) if got.num_rows else np.zeros((0, len(features)))
    return x, got.column("__y").to_numpy(), got.column("__w").to_numpy()


def fit(
    spark: SparkSession, x: np.ndarray, y: np.ndarray, w: np.ndarray, features: Sequence[str],
    num_trees: int, max_depth: int | None, seed: int, bootstrap: bool,
) -> Forest:
    """Grow ``num_trees`` trees, one a task. With ``bootstrap`` each draws as many rows as there are."""
    ship_code(spark)
    values = [np.unique(x[:, j]) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(v, x[:, j]) for j, v in enumerate(values)], 1).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                drawn = w
                if bootstrap and len(y):
                    picks = np.random.default_rng([seed, number]).integers(0, len(y), len(y))
                    drawn = w * np.bincount(picks, minlength=len(y))
                tree = grow(codes, values, y, drawn, max_depth)
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in tree.row(number)], names=TREES.names)

    rows = spark.range(0, num_trees, 1, num_trees).mapInArrow(run, TREES).collect()
    return Forest(list(features), [Tree.of(r) for r in sorted(rows, key=lambda r: r["tree"])])
