"""Physical-plan properties the scale design relies on (read from explain())."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import functions as F

from farecast.operators.features import model_matrix, model_matrix_joined
from farecast.operators.keys import with_row_index
from farecast.operators.model import score, train_run
from farecast.operators.sampling import split_exact, split_hashed, take_first
from farecast.plans.catalog import QUERIES
from farecast.plans.flows import training_split
from farecast.sources.files import read_months, read_table
from farecast.sources.fixtures import events_table, land_monthly, raw_trips_from_events
from tests.conftest import SMALL, saved_bronze, saved_silver


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def nodes(p: str, name: str) -> int:
    """Number of plan nodes called ``name`` (detail headers '(k) name')."""
    return len(re.findall(rf"^\(\d+\) {re.escape(name)}\b", p, flags=re.M))


def test_fused_matrix_is_one_scan_without_shuffle(spark):
    p = plan(model_matrix(saved_silver(spark, SMALL)))
    assert "Exchange" not in p and "Join" not in p
    assert nodes(p, "Scan parquet") == 1
    # only the needed columns are read
    read = re.search(r"ReadSchema: struct<(.*)>", p).group(1)
    assert sorted(re.findall(r"(\w+):", read)) == [
        "payment_type", "pickup_datetime", "pickup_taxi_zone_id", "tip_amount", "trip_id",
    ]


def test_joined_matrix_uses_hash_joins_on_key(spark):
    p = plan(model_matrix_joined(saved_silver(spark, SMALL)))
    assert nodes(p, "BroadcastHashJoin") + nodes(p, "SortMergeJoin") == 2


def test_period_read_prunes_partitions(spark):
    silver = saved_silver(spark, SMALL)
    path = silver.inputFiles()[0].rsplit("/metadata_year=", 1)[0]
    df = read_table(spark, path, (2022, 11))
    p = plan(df)
    filters = re.search(r"PartitionFilters: \[(.*)\]", p).group(1)
    assert "(metadata_year" in filters and "= 2022)" in filters and "(metadata_month" in filters and "= 11)" in filters


def test_row_index_moves_and_writes_keys_only(spark):
    bronze, keys = saved_bronze(spark, SMALL), ["metadata_year", "metadata_month", "tpep_pickup_datetime", "event_id"]
    got = with_row_index(bronze, keys[2:], keys[:2], "i")
    p = plan(got)
    # full rows are scanned and meet the numbers; they are neither exchanged nor sorted
    assert "SortMergeJoin" not in p and nodes(p, "Exchange") == 0 and nodes(p, "Sort") == 0
    written = {f.name for path in got.inputFiles() if "row-index-" in path and "offsets" not in path
               for f in spark.read.parquet(path.rsplit("/", 1)[0]).schema.fields}
    assert {c for c in written if not c.startswith("__rix")} == set(keys)
    # the keys themselves: one range exchange, and counting equal keys needs no other
    exchanges = plan(QUERIES["row_index"](spark, SMALL))
    assert nodes(exchanges, "Exchange") == 0 and "Window" not in exchanges


def test_rows_do_not_pass_through_python_when_scored(spark, scratch):
    run = train_run(training_split(saved_silver(spark, SMALL)), scratch("runs"), num_trees=3).run
    p = plan(score(model_matrix(saved_silver(spark, SMALL)), run))
    # distinct feature rows were predicted and written before; rows only meet them
    assert "Python" not in p and "MapInArrow" not in p and "BroadcastHashJoin" in p
    assert nodes(p, "Exchange") == 0


def test_take_first_and_exact_split_are_filters(spark):
    """The cut is found by counting hashes; then a row's side is one comparison."""
    m = model_matrix(saved_silver(spark, SMALL))
    for got in (take_first(m, 100), split_exact(m)):
        p = plan(got)
        assert "Exchange" not in p and "Window" not in p and "Sort" not in p and "TakeOrdered" not in p


def test_many_months_are_one_scan(spark, scratch):
    landing = scratch("landing")
    periods = land_monthly(raw_trips_from_events(events_table(spark, SMALL)), landing)
    p = plan(read_months(spark, landing, periods))
    assert nodes(p, "Scan parquet") == 1 and "Union" not in p
    files = read_months(spark, landing, periods[:1]).inputFiles()
    assert files and all("2022-01" in f for f in files)  # other months are not even listed


def test_bucketed_features_join_without_exchange(spark):
    p = plan(QUERIES["matrix_bucketed"](spark, SMALL))
    assert nodes(p, "SortMergeJoin") == 2 and "Exchange" not in p


def test_building_a_row_index_plans_no_input_job(spark):
    from farecast.operators.keys import default_ranges

    df = spark.range(1000).groupBy((F.col("id") % 7).alias("g")).count().repartition(3)
    assert default_ranges(df) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_hashed_split_is_a_projection(spark):
    p = plan(split_hashed(model_matrix(saved_silver(spark, SMALL))))
    assert "Exchange" not in p and "Window" not in p


def test_latest_view_aggregates_two_columns(spark, scratch):
    from farecast.operators.sinks import latest, upsert

    path = scratch("u")
    upsert(spark.range(10).select(F.col("id").alias("trip_id"), F.lit("a").alias("v")), path, 0)
    upsert(spark.range(5).select(F.col("id").alias("trip_id"), F.lit("b").alias("v")), path, 0, writer="other")
    p = plan(latest(spark, path))
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p and "HashAggregate" in p
