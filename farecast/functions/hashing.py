"""Deterministic, partition-independent order and sampling hash.

``hash_order(key, salt, seed)`` is the number in the first 15 hex digits of
``md5(salt|seed|key)``: a mixing hash that Spark and plain SQL compute alike.
Each purpose (sample, top-n, split) has its own salt, so a split of a sample
is still a split, and each seed gives another order. A null key hashes as
the text ``null``: it is sampled and split like any other key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 15
HASH_RANGE = 16**HASH_DIGITS
SAMPLE, TOP, SPLIT = "sample", "top", "split"


def hash_order(key: Column | str, salt: str = TOP, seed: int | None = None) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{salt}|{0 if seed is None else int(seed)}|"), F.coalesce(k.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, HASH_DIGITS), 16, 10).cast("long")
