"""Sinks (K1-K7), model runs (L2-L7, K8, K9, S8), streaming (M1-M6)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from farecast.functions.scalar import apply_scalar
from farecast.operators.model import evaluate, load_run, score
from farecast.operators.sinks import (
    append,
    compact,
    drop_table,
    latest,
    materialize,
    replace_period,
    sql_over,
    table_exists,
    upsert,
)
from farecast.plans.flows import bronze_from_events, load_month, score_flow, train_flow
from farecast.sources.files import monthly_path, read_format, read_table, read_trips, trips_from_rows
from farecast.sources.fixtures import events_table, land_monthly, raw_trips_from_events
from farecast.streaming.stream import await_progress, land_files, run_stream, scoring_batch, silver_batch, stream_trips
from tests.conftest import SMALL, saved_bronze, saved_silver


def _periods(df):
    return {(r[0], r[1]): r[2] for r in df.groupBy("metadata_year", "metadata_month").count().collect()}


def test_monthly_path_pads_month():
    assert monthly_path("/x", 2022, 1).endswith("yellow_tripdata_2022-01.parquet")
    assert monthly_path("/x/", 2022, 11) == "/x/yellow_tripdata_2022-11.parquet"


def test_replace_period_leaves_other_periods(spark, scratch):
    silver = saved_silver(spark, SMALL)
    path = scratch("periods")
    replace_period(silver, path)
    before = _periods(read_table(spark, path))
    nov = silver.where(F.col("metadata_month") == 11)
    replace_period(nov.unionByName(nov), path)
    doubled = _periods(read_table(spark, path))
    assert doubled[(2022, 11)] == 2 * before[(2022, 11)]
    assert doubled[(2022, 1)] == before[(2022, 1)] and doubled[(2022, 12)] == before[(2022, 12)]
    replace_period(nov, path)
    assert _periods(read_table(spark, path)) == before
    assert read_table(spark, path, (2022, 12)).count() == before[(2022, 12)]


def test_append_and_generic_read(spark, scratch):
    silver = saved_silver(spark, SMALL)
    path = scratch("append")
    append(silver, path)
    append(silver, path)
    assert read_format(spark, path).count() == 2 * silver.count()


def test_load_month_from_landed_file(spark, scratch):
    landing, bronze, silver_path = scratch("land"), scratch("bronze"), scratch("silver")
    raw = raw_trips_from_events(events_table(spark, SMALL))
    land_monthly(raw, landing)
    assert read_trips(spark, landing, 2022, 1).count() == raw.where(F.col("metadata_month") == 1).count()
    s1 = load_month(spark, landing, 2022, 11, bronze, silver_path)
    n11 = raw.where(F.col("metadata_month") == 11).count()
    assert s1.count() == n11
    load_month(spark, landing, 2022, 11, bronze, silver_path)  # re-run: period replaced, not doubled
    load_month(spark, landing, 2022, 12, bronze, silver_path)
    got = _periods(read_table(spark, silver_path))
    assert got[(2022, 11)] == n11 and (2022, 1) not in got
    ids = read_table(spark, silver_path).select("trip_id")
    assert ids.distinct().count() == ids.count()


def test_upsert_latest_wins_and_replay_is_idempotent(spark, scratch):
    path = scratch("upsert")
    b0 = spark.createDataFrame([(1, "a"), (2, "b")], "trip_id long, v string")
    b1 = spark.createDataFrame([(2, "B"), (3, "C")], "trip_id long, v string")
    upsert(b0, path, 0)
    upsert(b1, path, 1)
    first = sorted(tuple(r) for r in latest(spark, path).collect())
    upsert(b1, path, 1)  # replay of batch 1
    assert sorted(tuple(r) for r in latest(spark, path).collect()) == first == [(1, "a"), (2, "B"), (3, "C")]
    compacted = compact(spark, path, scratch("compact"))
    assert compacted.count() == 3


def test_upsert_rejects_duplicate_keys_in_batch(spark, scratch):
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "trip_id long, v string")
    with pytest.raises(ValueError, match="more than once"):
        upsert(dup, scratch("dup"), 0)


def test_materialize_and_catalog_helpers(spark, scratch):
    silver = saved_silver(spark, SMALL)
    ds = materialize(silver, scratch("mat"), "mat_silver_test", "cleaned trips")
    assert table_exists(spark, "mat_silver_test")
    assert ds.count() == silver.count()
    assert spark.catalog.getTable("mat_silver_test").description == "cleaned trips"
    out = sql_over(ds, "updates", "SELECT metadata_month, count(*) AS n FROM updates GROUP BY metadata_month")
    assert sum(r["n"] for r in out.collect()) == silver.count()
    drop_table(spark, "mat_silver_test")
    assert not table_exists(spark, "mat_silver_test")


def test_apply_scalar_pandas_udf(spark):
    df = spark.createDataFrame([(1, 1.5), (2, None)], "trip_id long, x double")
    got = dict(apply_scalar(df, "x", "y", lambda s: s * 2.0).select("trip_id", "y").collect())
    assert got[1] == 3.0 and got[2] is None


def test_evaluate_single_split_gives_one_row(spark):
    df = spark.createDataFrame([(1.0, 0.0, "train"), (3.0, 1.0, "train")],
                               "tip_amount double, tip_amount_predicted double, data_type string")
    rows = evaluate(df).collect()
    assert len(rows) == 1 and rows[0]["metric"] == "train_mean_square_error" and rows[0]["value"] == 2.5


@pytest.fixture(scope="module")
def trained(spark):
    from farecast.session import scratch_path

    silver = saved_silver(spark, "/root/testdata/sf0.01")
    return train_flow(silver, scratch_path(spark, "runs"), num_trees=10, max_depth=6), silver


def test_model_beats_train_mean(spark, trained):
    result, _ = trained
    metrics = {r["data_type"]: r["value"] for r in result.metrics.collect()}
    assert set(metrics) == {"train", "test"}
    test_rows = result.predictions.where(F.col("data_type") == "test")
    mean = result.predictions.where(F.col("data_type") == "train").agg(F.avg("tip_amount")).first()[0]
    base = test_rows.agg(F.avg(F.pow(F.col("tip_amount") - F.lit(mean), 2))).first()[0]
    assert metrics["test"] < 0.5 * base


def test_saved_run_scores_table_and_literal_rows(spark, trained):
    result, silver = trained
    run = load_run(spark, result.run.root, result.run.run_id)
    assert run.scaler == result.run.scaler
    preds = score_flow(silver, run)
    assert preds.count() == silver.count()
    assert preds.where(F.col("predicted_tip_amount").isNull()).count() == 0
    # one literal row takes the same code path (S6 -> L4 -> L5)
    row = silver.limit(1).collect()[0].asDict()
    one = score_flow(trips_from_rows(spark, [row]), run).collect()[0]
    same = preds.where(F.col("trip_id") == row["trip_id"]).collect()[0]
    assert one["predicted_tip_amount"] == same["predicted_tip_amount"]
    metrics = spark.read.parquet(f"{result.run.root}/metrics")
    assert metrics.where(F.col("run_id") == result.run.run_id).count() == 2


def test_stream_equals_batch_and_restart_reads_nothing(spark, scratch):
    bronze = bronze_from_events(spark, SMALL)
    landing, log, ckpt = scratch("in"), scratch("silver-log"), scratch("ckpt")
    land_files(bronze, landing, 4)
    q = run_stream(stream_trips(spark, landing, max_files=1), silver_batch(log), ckpt)
    p = await_progress(q, 300)
    assert p.finished and p.batches == 4 and p.rows == bronze.count()
    from farecast.operators.silver import to_silver

    batch = to_silver(bronze)
    streamed = latest(spark, log).select(*batch.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    q2 = run_stream(stream_trips(spark, landing, max_files=1), silver_batch(log), ckpt)
    p2 = await_progress(q2, 300)
    assert p2.batches == 0 and p2.rows == 0
    assert latest(spark, log).count() == batch.count()


def test_stream_scoring_equals_batch_scoring(spark, scratch, trained):
    result, _ = trained
    bronze = bronze_from_events(spark, SMALL)
    landing = scratch("in")
    land_files(bronze, landing, 2)
    silver_log, pred_log = scratch("s"), scratch("p")
    q = run_stream(stream_trips(spark, landing), scoring_batch(silver_log, pred_log, result.run), scratch("ckpt"))
    await_progress(q, 300)
    from farecast.operators.silver import to_silver

    want = score(__import__("farecast.operators.features", fromlist=["model_matrix"]).model_matrix(to_silver(bronze)), result.run)
    got = latest(spark, pred_log).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_processing_time_trigger_runs_until_stopped(spark, scratch):
    bronze = bronze_from_events(spark, SMALL)
    landing, log = scratch("in"), scratch("log")
    land_files(bronze, landing, 2)
    q = run_stream(stream_trips(spark, landing, max_files=1), silver_batch(log), scratch("ckpt"), trigger="1 second")
    try:
        q.processAllAvailable()  # blocks until both files are processed
        p = await_progress(q, 2)
        assert not p.finished and q.isActive  # a processing-time query keeps running
        assert p.batches == 2 and p.rows == bronze.count()
    finally:
        q.stop()
    assert latest(spark, log).count() == bronze.count()


def test_ensure_database_and_table_in_it(spark, scratch):
    from farecast.operators.sinks import ensure_database

    ensure_database(spark, "farecast_test_db")
    ensure_database(spark, "farecast_test_db")  # idempotent
    silver = saved_silver(spark, SMALL)
    materialize(silver, scratch("db"), "farecast_test_db.silver", "silver in a database")
    assert table_exists(spark, "farecast_test_db.silver")
    drop_table(spark, "farecast_test_db.silver")


def test_evaluate_with_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0, "test"), (3.0, 2.0, "test"), (5.0, 5.0, "test")],
                               "tip_amount double, tip_amount_predicted double, data_type string")
    got = {r["metric"]: r["value"] for r in evaluate(df, with_r2=True).collect()}
    mse, var = 1.0 / 3, 8.0 / 3
    assert got == {"test_mean_square_error": round(mse, 4), "test_r2": round(1 - mse / var, 4)}


def test_materialized_flow_scores_bronze_dataset(spark, scratch, trained):
    from farecast.plans.flows import materialized_flow

    result, _ = trained
    bronze = bronze_from_events(spark, SMALL)
    preds = materialized_flow(bronze, result.run, scratch("datasets"), database="farecast_flow_db")
    assert preds.columns == ["trip_id", "predicted_tip_amount"]
    assert spark.catalog.getTable("farecast_flow_db.predictions").description == "Predicted tip per trip"
    assert preds.count() == bronze.count()
    assert preds.join(bronze, "trip_id", "left_anti").count() == 0


def test_bucketed_upsert_table_latest_without_shuffle(spark, scratch):
    import contextlib
    import io

    from farecast.operators.sinks import create_upsert_table, latest_of_table, upsert_into

    silver = saved_silver(spark, SMALL)
    name = "farecast_upsert_log"
    drop_table(spark, name)
    create_upsert_table(spark, name, silver.schema, scratch("ulog"), buckets=4)
    upsert_into(silver.where(F.col("metadata_month").isin(1, 11)), name, 0)
    bumped = silver.where(F.col("metadata_month").isin(11, 12)).withColumn(
        "tip_amount", (F.col("tip_amount") + F.lit(1)).cast("decimal(13,2)")
    )
    upsert_into(bumped, name, 1)
    upsert_into(bumped, name, 1)  # replay
    view = latest_of_table(spark, name)
    assert view.count() == silver.count()
    want = silver.select("trip_id", F.when(F.col("metadata_month").isin(11, 12), F.col("tip_amount") + 1)
                         .otherwise(F.col("tip_amount")).cast("decimal(13,2)").alias("tip_amount"))
    assert view.select("trip_id", "tip_amount").exceptAll(want).count() == 0
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        view.explain()
    assert "Exchange" not in buf.getvalue() and "Bucketed: true" in buf.getvalue()
    with pytest.raises(ValueError, match="more than once"):
        upsert_into(silver.unionByName(silver.limit(1)), name, 2)
    drop_table(spark, name)


def test_stream_into_bucketed_tables(spark, scratch, trained):
    from farecast.operators.features import model_matrix
    from farecast.operators.silver import to_silver
    from farecast.operators.sinks import create_upsert_table, latest_of_table
    from farecast.schemas import PREDICTION, SILVER

    result, _ = trained
    bronze = bronze_from_events(spark, SMALL)
    landing = scratch("in")
    land_files(bronze, landing, 3)
    for name in ("farecast_silver_log", "farecast_pred_log"):
        drop_table(spark, name)
    create_upsert_table(spark, "farecast_silver_log", SILVER, scratch("sl"), buckets=4)
    create_upsert_table(spark, "farecast_pred_log", PREDICTION, scratch("pl"), buckets=4)
    q = run_stream(
        stream_trips(spark, landing, max_files=1),
        scoring_batch("farecast_silver_log", "farecast_pred_log", result.run, table=True),
        scratch("ckpt"),
    )
    assert await_progress(q, 300).batches == 3
    want = score(model_matrix(to_silver(bronze)), result.run)
    got = latest_of_table(spark, "farecast_pred_log").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert latest_of_table(spark, "farecast_silver_log").count() == bronze.count()


def test_read_table_by_catalog_name_with_period(spark, scratch):
    silver = saved_silver(spark, SMALL)
    path = scratch("named")
    replace_period(silver, path)
    drop_table(spark, "farecast_named_silver")
    spark.catalog.createTable("farecast_named_silver", path=path, source="parquet")
    spark.sql("MSCK REPAIR TABLE farecast_named_silver")  # register the period partitions
    nov = read_table(spark, "farecast_named_silver", (2022, 11))
    assert nov.count() == silver.where(F.col("metadata_month") == 11).count()
    drop_table(spark, "farecast_named_silver")


def test_read_format_other_formats_with_schema(spark, scratch):
    from farecast.schemas import SILVER

    silver = saved_silver(spark, SMALL).select(*SILVER.fieldNames())
    path = scratch("json")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # JSON's default keeps only milliseconds
    silver.write.option("timestampNTZFormat", micros).json(path)
    back = read_format(spark, path, "json", schema=SILVER, timestampNTZFormat=micros)
    assert back.schema == SILVER
    assert back.exceptAll(silver).count() == 0 and silver.exceptAll(back).count() == 0


def test_upserts_continue_on_a_compacted_log(spark, scratch):
    path, new = scratch("log"), scratch("compacted")
    upsert(spark.createDataFrame([(1, "a"), (2, "b")], "trip_id long, v string"), path, 0)
    upsert(spark.createDataFrame([(2, "B")], "trip_id long, v string"), path, 1)
    compact(spark, path, new)  # the view becomes batch 0 of the new log
    upsert(spark.createDataFrame([(1, "A"), (3, "c")], "trip_id long, v string"), new, 2)
    assert sorted(tuple(r) for r in latest(spark, new).collect()) == [(1, "A"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError, match="new directory"):
        compact(spark, new, new)


def test_two_writers_and_a_new_checkpoint_keep_each_others_rows(spark, scratch):
    path, new = scratch("log"), scratch("compacted")
    row = lambda *r: spark.createDataFrame(list(r), "trip_id long, v string")
    upsert(row((1, "a"), (2, "a")), path, 0, writer="first")
    upsert(row((2, "b"), (3, "b")), path, 0, writer="second")
    upsert(row((1, "a"), (2, "a")), path, 0, writer="first")  # a replay keeps its place in the order
    assert sorted(map(tuple, latest(spark, path).collect())) == [(1, "a"), (2, "b"), (3, "b")]
    compact(spark, path, new)
    upsert(row((3, "c")), new, 0, writer="first")
    upsert(row().limit(0), new, 1, writer="first")
    assert sorted(map(tuple, latest(spark, new).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_duplicate_batch_is_never_visible(spark, scratch):
    path = scratch("log")
    upsert(spark.createDataFrame([(1, "a")], "trip_id long, v string"), path, 0)
    with pytest.raises(ValueError):
        upsert(spark.createDataFrame([(1, "b"), (1, "c")], "trip_id long, v string"), path, 1)
    assert [tuple(r) for r in latest(spark, path).collect()] == [(1, "a")]


def test_empty_reload_empties_its_period(spark, scratch):
    path = scratch("t")
    df = spark.createDataFrame([(1, 2022, 1), (2, 2022, 2)], "id long, metadata_year int, metadata_month int")
    replace_period(df, path)
    replace_period(df.where("id < 0"), path, period=(2022, 1))
    assert [r["id"] for r in read_table(spark, path).collect()] == [2]


def test_stream_survives_an_empty_file_and_a_new_checkpoint(spark, scratch):
    bronze, landing, log = saved_bronze(spark, SMALL), scratch("in"), scratch("log")
    bronze.limit(0).coalesce(1).write.mode("append").parquet(landing)
    ckpt = scratch("ckpt")
    await_progress(run_stream(stream_trips(spark, landing), silver_batch(log), ckpt))
    bronze.write.mode("append").parquet(landing)
    p = await_progress(run_stream(stream_trips(spark, landing), silver_batch(log), ckpt))
    assert p.rows == bronze.count() == latest(spark, log).count()
    other = scratch("in")
    bronze.limit(10).coalesce(1).write.parquet(other)
    await_progress(run_stream(stream_trips(spark, other), silver_batch(log), scratch("ckpt")))  # batch 0 again
    assert latest(spark, log).count() == bronze.count()


def test_progress_counts_every_batch(spark, scratch):
    landing = scratch("in")
    spark.range(115).repartitionByRange(115, "id").write.parquet(landing)
    files = len(spark.read.parquet(landing).inputFiles())
    source = spark.readStream.schema("id long").option("maxFilesPerTrigger", "1").parquet(landing)
    p = await_progress(run_stream(source, lambda df, i: df.count(), scratch("ckpt")))
    assert files > 100 and (p.batches, p.rows, p.finished) == (files, 115, True)


def test_load_month_reads_the_published_types(spark, scratch):
    from farecast.plans.flows import load_month
    from farecast.sources.files import LANDED_FILE

    landing = scratch("landing")
    raw = spark.sql(
        """SELECT CAST(1 AS BIGINT) AS VendorID, TIMESTAMP_NTZ'2022-11-01 00:51:22' AS tpep_pickup_datetime,
           TIMESTAMP_NTZ'2022-11-01 00:56:24' AS tpep_dropoff_datetime, 1.0D AS passenger_count, 0.6D AS trip_distance,
           1.0D AS RatecodeID, 'N' AS store_and_fwd_flag, CAST(id AS BIGINT) AS PULocationID, 50L AS DOLocationID,
           1L AS payment_type, 4.5D AS fare_amount, 0.5D AS extra, 0.5D AS mta_tax, 0.0D AS tip_amount, 0.0D AS tolls_amount,
           0.3D AS improvement_surcharge, 5.8D AS total_amount, 0.0D AS congestion_surcharge FROM range(5)"""
    )
    raw.write.parquet(monthly_path(landing, 2022, 11, LANDED_FILE))
    order = ("tpep_pickup_datetime", "PULocationID")
    silver = load_month(spark, landing, 2022, 11, scratch("b"), scratch("s"), order_cols=order, template=LANDED_FILE)
    rows = silver.orderBy("trip_id").collect()
    assert [r["pickup_taxi_zone_id"] for r in rows] == [0, 1, 2, 3, 4]
    assert rows[0]["trip_id"] == 2022 * 10**14 + 11 * 10**12 and rows[0]["airport_fee"] is None
    assert str(rows[0]["fare_amount"]) == "4.50" and rows[0]["rate_type"] == "standard rate"


def test_files_without_an_id_are_keyed_by_position(spark, scratch):
    from farecast.plans.flows import load_month
    from farecast.operators.silver import load_bronze

    landing, bronze = scratch("landing"), scratch("b")
    raw = spark.range(1000).selectExpr("TIMESTAMP_NTZ'2022-11-01 00:51:22' AS tpep_pickup_datetime", "id AS PULocationID")
    raw.repartition(5).write.parquet(monthly_path(landing, 2022, 11))  # equal times: no column orders the rows
    keys = [
        {r["pickup_taxi_zone_id"]: r["trip_id"] for r in load_month(spark, landing, 2022, 11, bronze).collect()} for _ in (0, 1)
    ]
    base = 2022 * 10**14 + 11 * 10**12
    assert keys[0] == keys[1] and sorted(keys[0].values()) == [base + i for i in range(1000)]
    keyed = load_bronze(read_trips(spark, landing, 2022, 11, position=None), 2022, 11)
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    empty = scratch("empty")
    raw.limit(0).write.parquet(monthly_path(empty, 2022, 12))
    assert load_month(spark, empty, 2022, 12, bronze).count() == 0


def test_recording_metrics_again_replaces_them(spark, scratch):
    from farecast.operators.model import record_metrics

    root = scratch("runs")
    m = spark.createDataFrame([("train", "mse", 1.0)], "data_type string, metric string, value double")
    record_metrics(m, root, "r")
    assert record_metrics(m, root, "r").count() == 1
    assert spark.read.parquet(f"{root}/metrics").count() == 1


def test_registered_forests_are_the_operators_own(spark, monkeypatch):
    from farecast.operators.model import DEFAULT_TREES
    from farecast.plans import catalog

    fitted, train_run = [], catalog.train_run
    monkeypatch.setattr(catalog, "train_run", lambda *a, **k: fitted.append(train_run(*a, **k)) or fitted[-1])
    catalog.q_train_metrics(spark, SMALL)
    catalog.saved_run(spark, saved_silver(spark, SMALL))
    for result in fitted:
        trees = result.run.model.trees
        assert len(trees) == DEFAULT_TREES and len({len(t.feature) for t in trees}) > 1


# --- forest -----------------------------------------------------------------------


def _coded(x):
    import numpy as np

    values = [np.unique(x[:, j]) for j in range(x.shape[1])]
    return np.stack([np.searchsorted(v, x[:, j]) for j, v in enumerate(values)], 1), values


def _greedy(x, y):
    """A regression tree by trying every cut of every feature."""
    total = ((y - y.mean()) ** 2).sum()
    best = None
    if total > 1e-12:
        for j in range(x.shape[1]):
            seen = sorted(set(x[:, j]))
            for low, high in zip(seen, seen[1:]):
                left = x[:, j] <= low
                gain = total - sum(((part - part.mean()) ** 2).sum() for part in (y[left], y[~left]))
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, j, (low + high) / 2)
    if best is None:
        return lambda row: y.mean()
    _, j, cut = best
    left, right = _greedy(x[x[:, j] <= cut], y[x[:, j] <= cut]), _greedy(x[x[:, j] > cut], y[x[:, j] > cut])
    return lambda row: left(row) if row[j] <= cut else right(row)


def test_trees_are_the_greedy_ones():
    import numpy as np

    from farecast.operators.forest import grow

    r = np.random.default_rng(0)
    x = np.stack([r.integers(0, 9, 200), r.integers(0, 2, 200), r.integers(0, 30, 200)], 1).astype(float)
    y = r.normal(size=200)
    tree, want = grow(*_coded(x), y, np.ones(200)), _greedy(x, y)
    rows = np.stack([r.uniform(-1, 10, 300), r.uniform(-1, 2, 300), r.uniform(-1, 31, 300)], 1)
    assert np.allclose(tree.predict(rows), [want(row) for row in rows])
    # a row that counts k times is k rows
    times = r.integers(0, 4, 200)
    again = grow(*_coded(x), y, times.astype(float))
    whole = grow(*_coded(np.repeat(x, times, 0)), np.repeat(y, times), np.ones(times.sum()))
    assert np.allclose(again.predict(x), whole.predict(x))


def test_forest_edge_rows(spark, scratch):
    """Null features are a value of their own; unseen ones, no rows and one row have a prediction."""
    from farecast.operators.model import fit_forest

    rows = [(i, "train", float(i % 3), i % 3 if i % 3 else None) for i in range(30)]
    schema = "trip_id long, data_type string, tip_amount double, pickup_hour int"
    split = spark.createDataFrame(rows, schema).withColumn("pickup_taxi_zone_id", F.lit(1))
    exact = fit_forest(split, num_trees=1, features=["pickup_hour"], bootstrap=False)
    got = {r["pickup_hour"]: r["prediction"] for r in exact.transform(split).collect()}
    assert got == {None: 0.0, 1: 1.0, 2: 2.0}
    assert exact.transform(spark.createDataFrame([(77,), (None,)], "pickup_hour int")).count() == 2
    assert exact.transform(split.limit(0)).count() == 0
    none = fit_forest(split.limit(0), num_trees=2, features=["pickup_hour"])
    assert {r["prediction"] for r in none.transform(split).collect()} == {0.0}
    bagged = fit_forest(split, num_trees=5, features=["pickup_hour"])
    again = fit_forest(split.repartition(7), num_trees=5, features=["pickup_hour"])
    assert [t.row(0) for t in bagged.trees] == [t.row(0) for t in again.trees]  # the same on any partitioning
    with pytest.raises(ValueError, match="distinct feature rows"):
        fit_forest(split, features=["trip_id"], bootstrap=False, fit_rows=10)


def test_distributed_forest_on_all_rows(spark, scratch):
    """``fit_rows=None`` takes Spark ML's forest; a run of it is saved, loaded and scored the same way."""
    from farecast.operators.model import train_run
    from farecast.plans.flows import training_split

    silver = saved_silver(spark, SMALL)
    result = train_run(training_split(silver), scratch("runs"), num_trees=2, max_depth=3, fit_rows=None)
    run = load_run(spark, result.run.root, result.run.run_id)
    assert run.model.stages[-1].getNumTrees == 2
    assert score_flow(silver, run).count() == silver.count()


def test_a_save_that_dies_leaves_no_run(spark, scratch, monkeypatch):
    from farecast.operators import model
    from farecast.operators.model import Run, save_run
    from farecast.operators.forest import Forest

    root = scratch("runs")
    run = Run("r", root, Forest(["pickup_hour"], []), model.Scaler(1.0, 2.0))
    monkeypatch.setattr(model, "touch", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        save_run(run)  # everything but the marker
    with pytest.raises(FileNotFoundError):
        load_run(spark, root, "r")
    monkeypatch.undo()
    save_run(run)
    assert load_run(spark, root, "r").scaler == run.scaler
    monkeypatch.setattr(Forest, "save", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        save_run(run)  # a second save that dies between model and scaler
    with pytest.raises(FileNotFoundError):
        load_run(spark, root, "r")


# --- upsert log --------------------------------------------------------------------


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "trip_id long, v string")


def test_writers_that_begin_together_leave_one_row_a_key(spark, scratch):
    from farecast.operators.sinks import reserve

    path = scratch("log")
    assert reserve(spark, path, 0, "a") == reserve(spark, path, 0, "b") == (0, False)
    assert reserve(spark, path, 1, "a") == (0, False)  # and a second batch of one of them
    upsert(_rows(spark, (1, "b"), (2, "b")), path, 0, writer="b")
    upsert(_rows(spark, (1, "a0"), (3, "a0")), path, 0, writer="a")
    upsert(_rows(spark, (3, "a1")), path, 1, writer="a")
    assert sorted(map(tuple, latest(spark, path).collect())) == [(1, "b"), (2, "b"), (3, "a1")]
    upsert(_rows(spark, (1, "later")), path, 7, writer="a")
    assert dict(map(tuple, latest(spark, path).collect()))[1] == "later"


def test_writers_that_look_like_other_types_are_text(spark, scratch):
    path = scratch("log")
    from farecast.operators.sinks import reserve

    for w in ("10", "9", "007", "2024-01-01"):
        reserve(spark, path, 0, w)
    for w in ("10", "9", "007", "2024-01-01"):
        upsert(_rows(spark, (1, w)), path, 0, writer=w)
    assert [tuple(r) for r in latest(spark, path).collect()] == [(1, max("10", "9", "007", "2024-01-01"))]


def test_a_batch_reads_nothing_of_the_log(spark, scratch):
    """Numbers come from folder names: with every data file of the log destroyed, a new batch is still written,
    and a replay is known before its rows are computed."""
    import glob

    from farecast.operators.sinks import Batch, reserve

    path = scratch("log")
    for i in range(3):
        upsert(_rows(spark, (i, "x")), path, i)
    for f in glob.glob(path.removeprefix("file:") + "/**/*.parquet", recursive=True):
        with open(f, "wb") as out:
            out.write(b"no parquet")
    fails = _rows(spark, (1, "y")).withColumn("v", F.raise_error(F.lit("computed")).cast("string"))
    replay = upsert(fails, path, 1, check_unique=True)
    assert isinstance(replay, Batch) and not replay.new
    assert upsert(_rows(spark, (9, "z")), path, 1000).new and reserve(spark, path, 1001) == (4, False)


def test_a_batch_that_died_is_written_again_at_its_number(spark, scratch):
    from farecast.operators.sinks import reserve

    path = scratch("log")
    upsert(_rows(spark, (1, "a")), path, 0)
    with pytest.raises(Exception, match="died"):
        upsert(_rows(spark, (1, "b")).withColumn("v", F.raise_error(F.lit("died")).cast("string")), path, 1, check_unique=False)
    upsert(_rows(spark, (1, "c")), path, 2)
    number, done = reserve(spark, path, 1)
    assert not done and upsert(_rows(spark, (1, "b"), (2, "b")), path, 1).new
    assert sorted(map(tuple, latest(spark, path).collect())) == [(1, "c"), (2, "b")]


def test_changes_since_counts_inserted_and_updated_keys(spark, scratch):
    from farecast.operators.sinks import changes_since, next_number, read_log

    path = scratch("log")
    assert next_number(spark, path) == 0
    upsert(_rows(spark, (1, "a"), (2, "a")), path, 0)
    first = next_number(spark, path)
    assert tuple(changes_since(read_log(spark, path), first).first()) == (0, 0)
    upsert(_rows(spark, (2, "b"), (3, "b")), path, 1)
    upsert(_rows(spark, (3, "c"), (4, "c")), path, 2)
    assert tuple(changes_since(read_log(spark, path), first).first()) == (2, 1)


def test_a_compacted_log_can_remember_its_batches(spark, scratch):
    path, new, forgets = scratch("log"), scratch("new"), scratch("forgets")
    upsert(_rows(spark, (1, "a")), path, 0)
    upsert(_rows(spark, (1, "b")), path, 1)
    compact(spark, path, new, remember=True)
    compact(spark, path, forgets)
    assert not upsert(_rows(spark, (1, "a")), new, 0).new and upsert(_rows(spark, (1, "a")), forgets, 0).new
    assert [tuple(r) for r in latest(spark, new).collect()] == [(1, "b")]


# --- streams -------------------------------------------------------------------------


def test_a_file_that_vanishes_before_it_is_read_counts_as_empty(spark, scratch):
    """Removed after its batch was planned: passed over by default, a failure where the caller wants one."""
    import os

    bronze = saved_bronze(spark, SMALL)
    for ignore in (True, False):
        landing, log = scratch("in"), scratch("log")
        land_files(bronze, landing, 3)
        keep, lost = silver_batch(log), []

        def removes_its_file(df, i):
            if i == 1:
                lost.append(df.count())
                os.remove(df.select(F.input_file_name()).first()[0].removeprefix("file://"))
            keep(df, i)

        query = run_stream(stream_trips(spark, landing, max_files=1, ignore_missing=ignore), removes_its_file, scratch("ckpt"))
        if ignore:
            p = await_progress(query)
            assert p.finished and p.written == latest(spark, log).count() == bronze.count() - lost[0]
        else:
            with pytest.raises(Exception):
                await_progress(query)


def test_a_missing_end_event_raises(spark, scratch, monkeypatch):
    from farecast.streaming import stream

    landing = scratch("in")
    saved_bronze(spark, SMALL).limit(5).coalesce(1).write.parquet(landing)
    monkeypatch.setattr(stream._Counter, "onQueryTerminated", lambda self, event: None)
    query = run_stream(stream_trips(spark, landing), silver_batch(scratch("log")), scratch("ckpt"))
    with pytest.raises(TimeoutError, match="not reported"):
        await_progress(query, event_timeout_s=1)


def test_progress_can_be_awaited_in_another_thread(spark, scratch):
    import threading

    landing, got = scratch("in"), []
    saved_bronze(spark, SMALL).limit(7).coalesce(1).write.parquet(landing)
    query = run_stream(stream_trips(spark, landing), silver_batch(scratch("log")), scratch("ckpt"))
    waiter = threading.Thread(target=lambda: got.append(await_progress(query)))
    waiter.start()
    waiter.join(120)
    assert [(p.batches, p.rows, p.written) for p in got] == [(1, 7, 7)]
    from farecast.streaming import stream

    assert str(query.runId) not in stream._RUNNING  # nothing is kept of a run that was reported


# --- tables by name -------------------------------------------------------------------


def test_load_month_into_named_tables(spark, scratch):
    landing, name = scratch("land"), "farecast_named_load"
    raw = raw_trips_from_events(events_table(spark, SMALL))
    land_monthly(raw, landing)
    for t in (f"{name}_b", f"{name}_s"):
        drop_table(spark, t)
    for month in (11, 12, 11):
        loaded = load_month(spark, landing, 2022, month, f"{name}_b", f"{name}_s")
        assert loaded.count() == raw.where(F.col("metadata_month") == month).count()
    want = {(2022, m): raw.where(F.col("metadata_month") == m).count() for m in (11, 12)}
    assert _periods(read_table(spark, f"{name}_s")) == want
    replace_period(read_table(spark, scratch_of(spark, name, scratch)).where("false"), f"{name}_s", period=(2022, 12))
    assert set(_periods(read_table(spark, f"{name}_s"))) == {(2022, 11)}
    for t in (f"{name}_b", f"{name}_s"):
        drop_table(spark, t)


def scratch_of(spark, name, scratch):
    """A copy of the named silver table at a path (a table cannot be overwritten from itself)."""
    path = scratch("copy")
    read_table(spark, f"{name}_s").write.parquet(path)
    return path


def test_read_months_by_glob_and_by_period(spark, scratch):
    from farecast.sources.files import LANDED_FILE, read_months

    landing = scratch("land")
    raw = raw_trips_from_events(events_table(spark, SMALL))
    periods = land_monthly(raw, landing)
    want = raw.groupBy("metadata_year", "metadata_month").count()
    for got in (read_months(spark, landing), read_months(spark, landing, periods)):
        assert got.groupBy("metadata_year", "metadata_month").count().exceptAll(want).count() == 0
    other = scratch("land")
    raw.where("metadata_month = 1").drop("event_id").write.parquet(monthly_path(other, 2021, 3, LANDED_FILE))
    got = read_months(spark, other, template=LANDED_FILE)
    assert {(r["metadata_year"], r["metadata_month"], r["event_id"]) for r in got.collect()} == {(2021, 3, None)}


def test_forest_walks_once_for_all_rows_that_share_the_other_features(monkeypatch):
    """Same predictions, bit by bit, as row by row, on values between, beyond and at thresholds, and null ones."""
    import numpy as np

    from farecast.operators import forest

    r = np.random.default_rng(3)
    x = np.stack([r.integers(0, 900, 3000), r.integers(0, 24, 3000), r.integers(0, 2, 3000)], 1).astype(float)
    x[::40, 0], x[::70, 1] = np.inf, np.inf
    y, values = r.normal(size=3000) + x[:, 2], [np.unique(x[:, j]) for j in range(3)]
    codes = np.stack([np.searchsorted(v, x[:, j]) for j, v in enumerate(values)], 1).astype(np.int32)
    trees = [forest.grow(codes, values, y, np.bincount(r.integers(0, 3000, 3000), minlength=3000).astype(float)) for _ in range(6)]
    for kept in (trees, trees[:1], [forest.grow(codes, values, np.ones(3000), np.ones(3000))]):  # the last is one leaf
        model = forest.Forest(["zone", "hour", "flag"], kept)
        at, cuts = axis = model.axis()
        assert at == 0 and (np.diff(cuts) > 0).all()
        z = np.stack([r.integers(-50, 2000, 9000) / 2, r.integers(0, 26, 9000), r.integers(0, 2, 9000)], 1)
        z[::31, 0], z[::37, 1] = np.inf, np.inf
        z[: len(cuts), 0] = cuts[:9000]
        want, few = model.predict(z), model.predict(z[:20], axis)
        assert (few == want[:20]).all()
        with monkeypatch.context() as m:
            m.setattr(forest.Tree, "predict", None)  # no row goes down a tree
            assert (model.predict(z, axis) == want).all()
    hour_only = forest.Forest(["hour"], [forest.grow(codes[:, 1:2], values[1:2], y, np.ones(3000))])
    assert (hour_only.predict(z[:, 1:2], hour_only.axis()) == hour_only.predict(z[:, 1:2])).all()


def test_a_landed_file_is_read_by_many_tasks(spark, scratch):
    path = scratch()
    land_files(spark.range(1_200_000).select(F.col("id").alias("trip_id"), F.xxhash64("id").alias("x")), path, 1)
    assert spark.read.parquet(path).where("x is not null").groupBy(F.spark_partition_id()).count().count() > 1
    assert spark.read.parquet(path).count() == 1_200_000
