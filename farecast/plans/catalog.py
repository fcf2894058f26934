"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group, each over the whole shared test tables.

Every call reads the given tables anew; nothing is kept between calls. Queries
that read silver more than once write it below the shared folder first (as the
original pipeline saves its silver table), the others compute it in their own
plan. Outputs go through ``comparable`` (money as double, times as text) so
they compare across engines.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farecast.functions.scalar import apply_scalar, comparable, inverse_zscore
from farecast.operators.features import (
    model_matrix,
    model_matrix_bucketed,
    model_matrix_joined,
    payment_flags,
    pickup_hour,
)
from farecast.operators.keys import trip_key, trip_key_compat, with_row_index
from farecast.operators.model import Run, evaluate, fit_forest, load_run, predict_scaled, read_metrics, save_run, train_run
from farecast.operators.sampling import sample_fraction, split_hashed, take_first
from farecast.operators.scaling import fit_scaler, inverse_scale, scale, scaler_stats
from farecast.operators.silver import to_silver
from farecast.operators.sinks import (
    append,
    changes_since,
    compact,
    drop_table,
    ensure_database,
    latest,
    materialize,
    next_number,
    read_log,
    replace_period,
    reserve,
    reset,
    sql_over,
    table_exists,
    upsert,
)
from farecast.plans.flows import bronze_from_events, score_flow, training_split
from farecast.schemas import BRONZE, FEATURES, PERIOD_COLUMNS, SILVER
from farecast.session import list_names, move_path, remove_path, scratch_path
from farecast.sources.files import read_format, read_months, read_table
from farecast.sources.fixtures import events_table, fixture_periods, land_monthly, raw_trips_from_events
from farecast.streaming.stream import (
    await_progress,
    land_files,
    run_stream,
    scoring_batch,
    silver_batch,
    stream_trips,
)

TOP_ROWS = 1000
TRAIN_FRACTION = 0.7
FRACTION_SAMPLE = 0.25
STREAM_FILES = 4


def build_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(bronze_from_events(spark, sf_dir))


def saved_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed bronze of ``sf_dir``, written partitioned by period."""
    path = scratch_path(spark, "bronze")
    replace_period(bronze_from_events(spark, sf_dir), path)
    return read_table(spark, path, schema=BRONZE)


def saved_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of ``sf_dir``, written partitioned by period."""
    path = scratch_path(spark, "silver")
    replace_period(build_silver(spark, sf_dir), path)
    return read_table(spark, path, schema=SILVER)


def saved_run(spark: SparkSession, silver: DataFrame) -> Run:
    """A run trained on ``silver`` with the library's own settings, saved and loaded."""
    root = scratch_path(spark, "runs")
    result = train_run(training_split(silver, None, TRAIN_FRACTION), root)
    return load_run(spark, root, result.run.run_id)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips_from_events(events_table(spark, sf_dir))


# --- sources, keys, silver ---------------------------------------------------


def q_bronze_trips(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    periods = land_monthly(_raw(spark, sf_dir), landing)
    return comparable(read_months(spark, landing, periods), text_cols=("Payment_type",))


def q_row_index(spark, sf_dir):
    keys = _raw(spark, sf_dir).select("event_id", "tpep_pickup_datetime", *PERIOD_COLUMNS)
    return with_row_index(keys, ["tpep_pickup_datetime", "event_id"], PERIOD_COLUMNS, "idx").select("event_id", "idx")


def q_trip_key(spark, sf_dir):
    idx = with_row_index(_raw(spark, sf_dir), ["tpep_pickup_datetime", "event_id"], PERIOD_COLUMNS, "idx")
    return idx.select(
        "event_id",
        trip_key("metadata_year", "metadata_month", "idx").alias("trip_id"),
        trip_key_compat("metadata_year", "metadata_month", "idx").alias("compat_id"),
    )


def q_key_collisions(spark, sf_dir):
    keys = q_trip_key(spark, sf_dir)
    return keys.groupBy("compat_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def q_silver_trips(spark, sf_dir):
    return comparable(build_silver(spark, sf_dir))


def q_counts_by_period(spark, sf_dir):
    return build_silver(spark, sf_dir).groupBy(*PERIOD_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


def q_total_count(spark, sf_dir):
    return build_silver(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


# --- features ----------------------------------------------------------------


def q_pickup_hour(spark, sf_dir):
    return pickup_hour(build_silver(spark, sf_dir))


def q_payment_flags(spark, sf_dir):
    return payment_flags(build_silver(spark, sf_dir))


def q_matrix_joined(spark, sf_dir):
    return comparable(model_matrix_joined(saved_silver(spark, sf_dir)))


def q_matrix_bucketed(spark, sf_dir):
    """The joined matrix from bucketed tables; the catalog keeps none of them."""
    prefix = f"features_{uuid.uuid4().hex[:8]}"
    matrix = model_matrix_bucketed(saved_silver(spark, sf_dir), scratch_path(spark, "features"), prefix, buckets=8)
    for name in ("base", "hour", "payment"):
        drop_table(spark, f"{prefix}_{name}")  # their files stay, and the plan reads those
    return comparable(matrix)


def q_matrix_fused(spark, sf_dir):
    return comparable(model_matrix(build_silver(spark, sf_dir)))


# --- sampling, split, scaling ------------------------------------------------


def _matrix(spark, sf_dir):
    return model_matrix(build_silver(spark, sf_dir))


def _split(spark, sf_dir):
    return training_split(saved_silver(spark, sf_dir), None, TRAIN_FRACTION)


def _split_saved(spark, sf_dir):
    """The split, checkpointed once for queries that read it more than once
    (a scaler fit, then the rows)."""
    return _split(spark, sf_dir).checkpoint(eager=True)


def q_sample_top_n(spark, sf_dir):
    return comparable(take_first(model_matrix(saved_silver(spark, sf_dir)), TOP_ROWS))


def q_sample_fraction(spark, sf_dir):
    return sample_fraction(_matrix(spark, sf_dir), FRACTION_SAMPLE).select("trip_id")


def q_split_exact(spark, sf_dir):
    return _split(spark, sf_dir).select("trip_id", "data_type")


def q_split_hashed(spark, sf_dir):
    return split_hashed(_matrix(spark, sf_dir), TRAIN_FRACTION).select("trip_id", "data_type")


def q_train_rows(spark, sf_dir):
    return _split(spark, sf_dir).where(F.col("data_type") == F.lit("train")).select("trip_id")


def q_scaler_stats(spark, sf_dir):
    split = _split_saved(spark, sf_dir)
    both = scaler_stats(split, "tip_amount", "all").unionByName(scaler_stats(split, "tip_amount", "train"))
    return both.select("fit_on", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def q_scaled_target(spark, sf_dir):
    split = _split_saved(spark, sf_dir)
    scaled = scale(split, fit_scaler(split, "tip_amount", "all"), "tip_amount", "z")
    return scaled.select("trip_id", F.round("z", 6).alias("z"))


def q_inverse_scaled(spark, sf_dir):
    split = _split_saved(spark, sf_dir)
    scaler = fit_scaler(split, "tip_amount", "all")
    back = inverse_scale(scale(split, scaler, "tip_amount", "z"), scaler, "z", "tip_amount")
    return comparable(back.select("trip_id", "tip_amount"))


def q_baseline_mse(spark, sf_dir):
    """MSE of a per-hour train-mean predictor, in scaled units."""
    split = _split_saved(spark, sf_dir)
    scaled = scale(split, fit_scaler(split, "tip_amount", "all"), "tip_amount")
    train = scaled.where(F.col("data_type") == F.lit("train"))
    # one row per hour of day: the broadcast side is bounded by 24 rows
    hour_mean = train.groupBy("pickup_hour").agg(F.avg("tip_amount").alias("hour_mean"))
    overall = fit_scaler(train, "tip_amount", "all").mean
    pred = scaled.join(F.broadcast(hour_mean), "pickup_hour", "left").withColumn(
        "tip_amount_predicted", F.coalesce(F.col("hour_mean"), F.lit(overall))
    )
    return evaluate(pred)


# --- model -------------------------------------------------------------------


def q_train_metrics(spark, sf_dir):
    result = train_run(_split(spark, sf_dir), scratch_path(spark, "runs"))
    return result.metrics


TREE_FEATURES = [f for f in FEATURES if f != "pickup_taxi_zone_id"]


def q_tree_predictions(spark, sf_dir):
    """One full tree on hour and payment flags: fit, save, load, predict, unscale.

    Its leaves are the groups of equal features, so each prediction is the
    train mean of its group. Every row is predicted; in a group without train
    rows the value is whatever leaf the tree leads to, so it is not shown, only
    that there is one."""
    split = _split_saved(spark, sf_dir)
    scaler = fit_scaler(split, "tip_amount", "all")
    scaled = scale(split, scaler, "tip_amount")
    model = fit_forest(scaled, num_trees=1, features=TREE_FEATURES, bootstrap=False)
    root = scratch_path(spark, "runs")
    save_run(Run("tree", root, model, scaler))
    run = load_run(spark, root, "tree")
    train = F.col("data_type") == F.lit("train")
    seen = split.where(train).select(*TREE_FEATURES).distinct().withColumn("seen", F.lit(True))
    pred = predict_scaled(run.model, split, "z").join(seen, TREE_FEATURES, "left")
    tip = inverse_zscore(F.col("z"), run.scaler.mean, run.scaler.std)
    return pred.select(
        "trip_id", "data_type", F.col("z").isNotNull().alias("has_value"),
        F.when(F.col("seen"), F.round(tip, 6)).alias("predicted"),
    )


def _hour_tree(spark, split: DataFrame) -> Run:
    """A published run of one full tree on the hour: its predictions are the train means of the hours."""
    root = scratch_path(spark, "runs")
    result = train_run(split, root, num_trees=1, bootstrap=False, features=["pickup_hour"])
    return load_run(spark, root, result.run.run_id)


def q_exact_tree_metrics(spark, sf_dir):
    """The metrics of a whole training run, as recorded with it and read back."""
    run = _hour_tree(spark, _split(spark, sf_dir))
    return read_metrics(spark, run.root, run.run_id)


def q_exact_tree_scores(spark, sf_dir):
    """Batch scoring of every trip with a published run of one exact tree."""
    silver = saved_silver(spark, sf_dir)
    run = _hour_tree(spark, training_split(silver, None, TRAIN_FRACTION))
    return comparable(score_flow(silver, run))


def q_batch_predictions(spark, sf_dir):
    silver = saved_silver(spark, sf_dir)
    return comparable(score_flow(silver, saved_run(spark, silver)))


# --- sinks -------------------------------------------------------------------


def q_replace_period(spark, sf_dir):
    silver = saved_silver(spark, sf_dir)
    path = scratch_path(spark, "silver-table")
    replace_period(silver, path)
    nov = silver.where((F.col("metadata_year") == 2022) & (F.col("metadata_month") == 11))
    replace_period(nov.where(F.lit(False)), path, period=(2022, 11))  # a reload without rows empties its period ...
    replace_period(nov.unionByName(nov), path)  # a faulty double load of one period ...
    replace_period(nov, path, period=(2022, 11))  # ... replaced by the reload
    return read_table(spark, path).groupBy(*PERIOD_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


def q_append_table(spark, sf_dir):
    silver = saved_silver(spark, sf_dir)
    path = scratch_path(spark, "appended")
    periods = fixture_periods()
    for y, m in periods:  # one append per monthly load
        append(silver.where((F.col("metadata_year") == y) & (F.col("metadata_month") == m)), path, PERIOD_COLUMNS)
    one = read_table(spark, path, periods[0])
    rest = read_format(spark, path).where(
        ~((F.col("metadata_year") == periods[0][0]) & (F.col("metadata_month") == periods[0][1]))
    )
    return one.unionByName(rest).agg(F.count(F.lit(1)).alias("n"))


def _amounts(silver: DataFrame, months: list[int], bump: str) -> DataFrame:
    return silver.where(F.col("metadata_month").isin(months)).select(
        "trip_id", (F.col("tip_amount") + F.lit(bump).cast("decimal(13,2)")).alias("amount")
    )


def q_upsert_latest(spark, sf_dir):
    silver = saved_silver(spark, sf_dir)
    path = scratch_path(spark, "upsert")
    upsert(_amounts(silver, [1, 11], "0.00"), path, 0)
    upsert(_amounts(silver, [11, 12], "1.00"), path, 1)
    upsert(_amounts(silver, [11, 12], "1.00"), path, 1)  # replayed batch
    return comparable(latest(spark, path))


def q_upsert_two_writers(spark, sf_dir):
    """Two writers with their own batch ids, a compaction, and a batch after it."""
    silver = saved_silver(spark, sf_dir)
    path, compacted = scratch_path(spark, "upsert"), scratch_path(spark, "upsert-compacted")
    upsert(_amounts(silver, [1, 11], "0.00"), path, 0, writer="a")
    upsert(_amounts(silver, [11, 12], "1.00"), path, 0, writer="b")
    upsert(_amounts(silver, [], "9.00"), path, 1, writer="b")  # an empty batch
    compact(spark, path, compacted)
    upsert(_amounts(silver, [12], "2.00"), compacted, 0, writer="a")
    return comparable(latest(spark, compacted))


def q_upsert_same_number(spark, sf_dir):
    """Two writers that both begin before either has written take the same number; a key has one row still:
    that of the writer whose name is later."""
    silver = saved_silver(spark, sf_dir)
    path = scratch_path(spark, "upsert")
    numbers = [reserve(spark, path, 0, writer)[0] for writer in ("b", "a")]
    assert numbers[0] == numbers[1]
    upsert(_amounts(silver, [11, 12], "1.00"), path, 0, writer="b")
    upsert(_amounts(silver, [1, 11], "0.00"), path, 0, writer="a")
    upsert(_amounts(silver, [1], "5.00"), path, 0, writer="a")  # known as a replay: not written
    return comparable(latest(spark, path))


def q_materialized(spark, sf_dir):
    name, path = f"silver_{uuid.uuid4().hex[:8]}", scratch_path(spark, "materialized")
    schema = materialize(build_silver(spark, sf_dir), path, name, "cleaned trips").schema
    drop_table(spark, name)  # the demo leaves nothing in the catalog
    ds = read_table(spark, path, schema=schema)
    return ds.groupBy(*PERIOD_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


def q_table_lifecycle(spark, sf_dir):
    """A table by name: made at its first load, loaded month by month, reloaded, read by SQL, dropped (K4-K6)."""
    database = f"trips_{uuid.uuid4().hex[:8]}"
    silver, table = saved_silver(spark, sf_dir), f"{database}.silver"
    ensure_database(spark, database)
    reset(spark, table)  # nothing there yet
    before = table_exists(spark, table)
    for y, m in fixture_periods():
        month = silver.where((F.col("metadata_year") == y) & (F.col("metadata_month") == m))
        replace_period(month.unionByName(month), table, period=(y, m))  # a faulty double load ...
        replace_period(month, table, period=(y, m))  # ... replaced
    replace_period(silver.where("false"), table, period=(2022, 12))  # a reload without rows empties its month
    december = silver.where("metadata_month = 12").select(*read_table(spark, table, (2022, 11)).columns)
    append(december, table, PERIOD_COLUMNS)
    counts = sql_over(
        read_table(spark, table), "loaded",
        "SELECT metadata_year, metadata_month, count(*) AS n, sum(tip_amount) AS tips FROM loaded GROUP BY ALL",
    )
    rows = [(*r, before, table_exists(spark, table)) for r in comparable(counts).collect()]  # one a period
    reset(spark, table)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    columns = "metadata_year int, metadata_month int, n long, tips double, before boolean, after boolean"
    return spark.createDataFrame(rows, columns)


# --- streaming ---------------------------------------------------------------


def _drain(spark, landing: str, process, checkpoint: str | None = None):
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    return await_progress(run_stream(stream_trips(spark, landing, max_files=1), process, checkpoint))


def _landed(spark, bronze: DataFrame, files: int = STREAM_FILES) -> str:
    """Bronze rows landed as so many files, one per micro-batch."""
    landing = scratch_path(spark, "stream-in")
    land_files(bronze, landing, files)
    return landing


def q_stream_silver(spark, sf_dir):
    silver_log = scratch_path(spark, "stream-silver")
    _drain(spark, _landed(spark, saved_bronze(spark, sf_dir)), silver_batch(silver_log))
    return comparable(latest(spark, silver_log))


def q_stream_predictions(spark, sf_dir):
    bronze = saved_bronze(spark, sf_dir)
    run = saved_run(spark, to_silver(bronze))
    silver_log, pred_log = scratch_path(spark, "stream-silver"), scratch_path(spark, "stream-pred")
    _drain(spark, _landed(spark, bronze), scoring_batch(silver_log, pred_log, run))
    return comparable(latest(spark, pred_log))


def q_stream_progress(spark, sf_dir):
    """A run into a sink that holds two months already: micro-batches, rows read and written (from the
    run's own events and observations), and the keys it inserted and updated."""
    bronze = saved_bronze(spark, sf_dir)
    silver_log = scratch_path(spark, "stream-silver")
    _drain(spark, _landed(spark, bronze.where(F.col("metadata_month").isin(1, 11)), 2), silver_batch(silver_log))
    first = next_number(spark, silver_log)
    p = _drain(spark, _landed(spark, bronze), silver_batch(silver_log))
    changed = changes_since(read_log(spark, silver_log), first)
    counts = [F.lit(v).cast("long").alias(n) for n, v in (("batches", p.batches), ("rows", p.rows), ("written", p.written))]
    return changed.select(*counts, "inserted", "updated")


def q_stream_after_delete(spark, sf_dir):
    """Two runs on one checkpoint; between them one landed file vanishes and another is rewritten under
    its name. What was processed stays, and only the new file is read (S5)."""
    bronze, landing = saved_bronze(spark, sf_dir), scratch_path(spark, "stream-in")
    silver_log, checkpoint = scratch_path(spark, "stream-silver"), scratch_path(spark, "stream-ckpt")

    def land(month: int, **changes) -> str:
        before = set(list_names(spark, landing))
        rows = bronze.where(F.col("metadata_month") == month).withColumns(changes)
        land_files(rows, landing, 1)
        [new] = [n for n in list_names(spark, landing) if n.endswith(".parquet") and n not in before]
        return f"{landing}/{new}"

    gone, rewritten = land(1), land(11)
    _drain(spark, landing, silver_batch(silver_log), checkpoint)
    remove_path(spark, gone)
    move_path(spark, land(11, tip_amount=F.lit("99.00").cast("decimal(13,2)")), rewritten)
    land(12)
    _drain(spark, landing, silver_batch(silver_log), checkpoint)
    return comparable(latest(spark, silver_log))


# --- UDF surface ---------------------------------------------------------------


def _double(s: pd.Series) -> pd.Series:
    return s * 2.0


def q_apply_scalar(spark, sf_dir):
    silver = build_silver(spark, sf_dir).select("trip_id", F.col("tip_amount").cast("double").alias("tip"))
    return apply_scalar(silver, "tip", "tip_doubled", _double).select("trip_id", "tip_doubled")


QUERIES = {
    "bronze_trips": q_bronze_trips,
    "row_index": q_row_index,
    "trip_key": q_trip_key,
    "key_collisions": q_key_collisions,
    "silver_trips": q_silver_trips,
    "counts_by_period": q_counts_by_period,
    "total_count": q_total_count,
    "pickup_hour": q_pickup_hour,
    "payment_flags": q_payment_flags,
    "matrix_joined": q_matrix_joined,
    "matrix_fused": q_matrix_fused,
    "matrix_bucketed": q_matrix_bucketed,
    "sample_top_n": q_sample_top_n,
    "sample_fraction": q_sample_fraction,
    "split_exact": q_split_exact,
    "split_hashed": q_split_hashed,
    "train_rows": q_train_rows,
    "scaler_stats": q_scaler_stats,
    "scaled_target": q_scaled_target,
    "inverse_scaled": q_inverse_scaled,
    "baseline_mse": q_baseline_mse,
    "train_metrics": q_train_metrics,
    "tree_predictions": q_tree_predictions,
    "exact_tree_metrics": q_exact_tree_metrics,
    "exact_tree_scores": q_exact_tree_scores,
    "batch_predictions": q_batch_predictions,
    "replace_period": q_replace_period,
    "append_table": q_append_table,
    "upsert_latest": q_upsert_latest,
    "upsert_two_writers": q_upsert_two_writers,
    "upsert_same_number": q_upsert_same_number,
    "materialized": q_materialized,
    "table_lifecycle": q_table_lifecycle,
    "stream_silver": q_stream_silver,
    "stream_predictions": q_stream_predictions,
    "stream_progress": q_stream_progress,
    "stream_after_delete": q_stream_after_delete,
    "apply_scalar": q_apply_scalar,
}
