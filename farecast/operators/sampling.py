"""Deterministic sampling, top-n and train/test splits.

All of them order rows by a salted hash of the key, then the key: a total
order that does not depend on partitioning, so every run and every engine
picks the same rows. Sample, top-n and split use different salts.

* ``sample_fraction`` (N1): keep rows whose hash falls below a threshold --
  a per-row filter, no shuffle.
* ``take_first`` (N2) and ``split_exact`` (N3 + N4) cut that order at an exact
  position. The cut is found by selection (``cuts``): rows are counted by the
  leading bits of their hash, then the one bucket that holds the position is
  counted by its next bits, until the row there is known. That takes two or
  three aggregates over the key column alone -- nothing is sorted, no full
  row is shuffled or copied -- and then a row's side is one comparison.
* ``split_hashed`` (N3 at scale): train iff ``hash < fraction * range``, per row.

Rows that share a key cannot be told apart by the order, so they stay on one
side: with repeated keys a cut lies after the last row of the key it falls in.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farecast.functions.hashing import HASH_RANGE, SAMPLE, SPLIT, TOP, hash_order

DEFAULT_SAMPLE_ROWS = 50000
DEFAULT_TRAIN_FRACTION = 0.7

HASH_BITS = HASH_RANGE.bit_length() - 1
LEVEL_BITS = 15  # a level of the selection brings at most 2**15 counts to the driver
FEW = 2048  # a bucket with so few rows is read instead of counted again


def _threshold(fraction: float) -> int:
    return min(HASH_RANGE, math.ceil(fraction * HASH_RANGE))


def sample_fraction(df: DataFrame, fraction: float, key: str = "trip_id", seed: int | None = None) -> DataFrame:
    """Rows whose hash lies in the first ``fraction`` of the hash range.

    ``fraction=1.0`` keeps every row. The kept set only grows with the
    fraction. ``seed`` picks another hash order.
    """
    return df.where(hash_order(key, SAMPLE, seed) < F.lit(_threshold(fraction)))


@dataclass(frozen=True)
class Cut:
    """A position in the hash order: the last row before it, or all rows (``hash is None``), or none (-1)."""

    hash: int | None
    key: object = None

    def before(self, key: str, salt: str, seed: int | None) -> Column:
        """Whether a row lies before the cut."""
        if self.hash is None:
            return F.lit(True)
        h = hash_order(key, salt, seed)
        last = F.col(key).isNull() if self.key is None else F.col(key).isNull() | (F.col(key) <= F.lit(self.key))
        return (h < F.lit(self.hash)) | ((h == F.lit(self.hash)) & last)


def _find(hashed: DataFrame, counts: dict[int, int], position: int) -> Cut:
    """The row at 1-based ``position`` of (h, k); ``counts`` are the rows by their leading LEVEL_BITS bits."""
    shift, low = HASH_BITS - LEVEL_BITS, 0
    while True:
        for bucket in sorted(counts):
            if position <= counts[bucket]:
                break
            position -= counts[bucket]
        low, rows = low + (bucket << shift), counts[bucket]
        inside = hashed.where((F.col("h") >= F.lit(low)) & (F.col("h") < F.lit(low + (1 << shift))))
        if rows <= FEW or shift == 0:
            break
        step = min(LEVEL_BITS, shift)
        shift -= step
        part = F.shiftright(F.col("h") - F.lit(low), shift)
        counts = dict(inside.select(part.alias("b")).groupBy("b").count().collect())
    # few rows, or (at the last bit) rows of one hash, which hardly ever have two keys
    for r in sorted(inside.groupBy("h", "k").count().collect(), key=lambda r: (r["h"], r["k"] is not None, r["k"])):
        position -= r["count"]
        if position <= 0:
            return Cut(r["h"], r["k"])
    raise AssertionError("counts changed between two passes over the same rows")


def cuts(df: DataFrame, positions, key: str = "trip_id", salt: str = SPLIT, seed: int | None = None) -> list[Cut]:
    """Cuts of the hash order after so many rows; ``positions`` may be a function of the row count."""
    hashed = df.select(hash_order(key, salt, seed).alias("h"), F.col(key).alias("k"))
    first = F.shiftright("h", HASH_BITS - LEVEL_BITS)
    counts = dict(hashed.select(first.alias("b")).groupBy("b").count().collect())
    total = sum(counts.values())
    wanted: Sequence[int] = positions(total) if callable(positions) else positions
    return [Cut(None) if n >= total else Cut(-1) if n <= 0 else _find(hashed, counts, n) for n in wanted]


def take_first(
    df: DataFrame, n: int = DEFAULT_SAMPLE_ROWS, key: str = "trip_id", seed: int | None = None
) -> DataFrame:
    """The first ``n`` rows by (hash order, key); all rows if there are fewer."""
    [cut] = cuts(df, [n], key, TOP, seed)
    return df if cut.hash is None else df.where(cut.before(key, TOP, seed))


def split_exact(
    df: DataFrame,
    train: float = DEFAULT_TRAIN_FRACTION,
    validation: float = 0.0,
    key: str = "trip_id",
    seed: int | None = None,
) -> DataFrame:
    """Tag ``data_type``: the first ``int(train * rows)`` rows of the hash
    order are 'train', the next ``int(validation * rows)`` 'validation', the
    rest 'test'."""

    def positions(rows: int) -> list[int]:
        k = int(train * rows)
        return [k, k + int(validation * rows)] if validation else [k]

    found = cuts(df, positions, key, SPLIT, seed)
    tag = F.when(found[0].before(key, SPLIT, seed), F.lit("train"))
    if validation:
        tag = tag.when(found[1].before(key, SPLIT, seed), F.lit("validation"))
    return df.withColumn("data_type", tag.otherwise(F.lit("test")))


def split_hashed(
    df: DataFrame, train: float = DEFAULT_TRAIN_FRACTION, key: str = "trip_id", seed: int | None = None
) -> DataFrame:
    """Tag ``data_type`` per row: 'train' iff the hash lies in the first
    ``train`` share of the hash range. No count, no shuffle."""
    h = hash_order(key, SPLIT, seed)
    return df.withColumn(
        "data_type", F.when(h < F.lit(_threshold(train)), F.lit("train")).otherwise(F.lit("test"))
    )
