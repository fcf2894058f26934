"""End-to-end flows composed from the step functions.

Steps are plain ``DataFrame -> DataFrame`` functions; a flow chains them and
any input can be replaced by passing a different frame (C2); per-step
parameters are keyword arguments (C3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from farecast.operators.features import model_matrix
from farecast.operators.model import DEFAULT_TREES, Run, TrainResult, score, train_run
from farecast.operators.sampling import DEFAULT_SAMPLE_ROWS, DEFAULT_TRAIN_FRACTION, split_exact, take_first
from farecast.operators.silver import TRIP_ORDER, load_bronze, to_silver
from farecast.operators.sinks import ensure_database, materialize, replace_period
from farecast.schemas import BRONZE, SILVER
from farecast.sources.files import MONTHLY_FILE, read_table, read_trips
from farecast.sources.fixtures import events_table, raw_trips_from_events


def bronze_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed bronze rows from the shared ``events`` test table."""
    return load_bronze(raw_trips_from_events(events_table(spark, sf_dir)))


def load_month(
    spark: SparkSession,
    landing: str,
    year: int,
    month: int,
    bronze_path: str,
    silver_path: str | None = None,
    order_cols: Sequence[str] | None = None,
    template: str = MONTHLY_FILE,
) -> DataFrame:
    """Load one monthly file: scan, tag, key, replace the period in bronze
    (and silver when ``silver_path`` is given). Returns the period's silver.

    Rows are numbered in ``order_cols`` order if given; else by pickup time
    and ``event_id``, or by their place in the file where it has no such id."""
    raw = read_trips(spark, landing, year, month, template=template, position=False if order_cols else None)
    bronze = load_bronze(raw, year, month, order_cols=order_cols or TRIP_ORDER)
    replace_period(bronze, bronze_path, period=(year, month))
    silver = to_silver(read_table(spark, bronze_path, (year, month), schema=BRONZE))
    if silver_path:
        replace_period(silver, silver_path, period=(year, month))
        return read_table(spark, silver_path, (year, month), schema=SILVER)
    return silver


def training_split(
    silver: DataFrame,
    rows: int | None = DEFAULT_SAMPLE_ROWS,
    train: float = DEFAULT_TRAIN_FRACTION,
    validation: float = 0.0,
) -> DataFrame:
    """matrix -> first ``rows`` of the hash order (``None``: all rows) ->
    positional train / (optional) validation / test split."""
    if rows is None:
        return split_exact(model_matrix(silver), train, validation)
    return split_exact(take_first(model_matrix(silver), rows), train, validation)


def train_flow(
    silver: DataFrame,
    root: str,
    run_id: str | None = None,
    rows: int = DEFAULT_SAMPLE_ROWS,
    train: float = DEFAULT_TRAIN_FRACTION,
    fit_on: str = "all",
    num_trees: int = DEFAULT_TREES,
    max_depth: int | None = None,
    validation: float = 0.0,
) -> TrainResult:
    """Sample, split, scale, fit and save; metrics get one row per split."""
    return train_run(training_split(silver, rows, train, validation), root, run_id, fit_on, num_trees, max_depth)


def score_flow(silver: DataFrame, run: Run) -> DataFrame:
    """silver (table, stream batch or literal rows) -> predictions."""
    return score(model_matrix(silver), run)


def materialized_flow(bronze: DataFrame, run: Run, root: str, database: str | None = None) -> DataFrame:
    """Two commented datasets, the second reading the first (K7):
    ``bronze_trips`` (the given bronze rows) -> ``predictions`` (scored).
    With ``database`` both are registered there under those names with their
    comments. Returns the predictions dataset as read back."""
    root = root.rstrip("/")
    names = (f"{database}.bronze_trips", f"{database}.predictions") if database else (None, None)
    if database:
        ensure_database(bronze.sparkSession, database)
    stored = materialize(bronze, f"{root}/bronze_trips", names[0], "Keyed raw trips as loaded")
    return materialize(score_flow(to_silver(stored), run), f"{root}/predictions", names[1], "Predicted tip per trip")
