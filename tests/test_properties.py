"""Property tests of the two custom distributed operators against brute force
on random small inputs: the dense row index (any group sizes, one dominant
group, any number of ranges) and the hash-order top-n (any n)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farecast.functions.hashing import hash_order
from farecast.operators.keys import with_row_index
from farecast.operators.sampling import take_first

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(
    groups=st.lists(st.integers(min_value=0, max_value=3), min_size=1, max_size=300),
    ranges=st.integers(min_value=1, max_value=9),
    order=st.lists(st.integers(min_value=0, max_value=20), min_size=300, max_size=300),
)
def test_row_index_equals_brute_force(spark, groups, ranges, order):
    rows = [(i, g, order[i]) for i, g in enumerate(groups)]
    df = spark.createDataFrame(rows, "id long, g int, o int").repartition(3)
    got = {r["id"]: r["ix"] for r in with_row_index(df, ["o", "id"], ["g"], "ix", num_ranges=ranges).collect()}
    want: dict[int, int] = {}
    for g in set(groups):
        members = sorted((o, i) for i, gg, o in rows if gg == g)
        want.update({i: k for k, (_, i) in enumerate(members)})
    assert got == want


@SETTINGS
@given(n=st.integers(min_value=1, max_value=1200), seed_rows=st.integers(min_value=50, max_value=1000))
def test_take_first_equals_sorted_prefix(spark, n, seed_rows):
    df = spark.range(seed_rows).select((F.col("id") * 7919 + 13).alias("trip_id"), F.col("id").alias("x"))
    ordered = [r["trip_id"] for r in df.select("trip_id", hash_order("trip_id").alias("h")).orderBy("h", "trip_id").collect()]
    got = sorted(r["trip_id"] for r in take_first(df, n).collect())
    assert got == sorted(ordered[:n])
