"""Joins (J1 and internal lookups). Nothing is broadcast by a hint: small sides are
tables written before, so Catalyst knows their size in bytes and picks the join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equi-join condition on ``keys`` in which NULL matches NULL."""
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def left_join_features(base: DataFrame, feature: DataFrame, key: str = "trip_id") -> DataFrame:
    """Left equi-join of a feature frame on its key.

    The physical strategy is left to Catalyst and AQE: a small feature frame
    becomes a broadcast hash join, a large one a sort-merge join that AQE may
    split when a key is skewed. Frames read from tables bucketed by the key
    (``bucketed_features``) are joined bucket by bucket, without an exchange.
    """
    return base.join(feature, on=key, how="left")


def bucketed_features(df: DataFrame, name: str, path: str, key: str = "trip_id", buckets: int = 64) -> DataFrame:
    """Write a feature frame as a table bucketed and sorted by its key, and return the table.

    Frames bucketed alike are joined on the key without an exchange or a sort, every time they are
    read; the one shuffle is here. Size ``buckets`` for the largest of them (e.g. its size / 256 MB)."""
    (
        df.repartition(int(buckets), key)  # one file a bucket
        .write.mode("overwrite").bucketBy(int(buckets), key).sortBy(key).option("path", path).saveAsTable(name)
    )
    return df.sparkSession.table(name)
