"""Operators: ``DataFrame -> DataFrame`` steps of the trip pipeline."""

from farecast.operators.features import model_matrix, model_matrix_bucketed, model_matrix_joined, payment_flags, pickup_hour
from farecast.operators.joins import bucketed_features, left_join_features
from farecast.operators.keys import assign_trip_key, key_index, trip_key, trip_key_compat, with_row_index
from farecast.operators.model import (
    Run,
    TrainResult,
    evaluate,
    fit_forest,
    load_run,
    predict_scaled,
    read_metrics,
    record_metrics,
    save_run,
    score,
    train_run,
)
from farecast.operators.sampling import sample_fraction, split_exact, split_hashed, take_first
from farecast.operators.scaling import Scaler, fit_scaler, inverse_scale, scale, scaler_stats
from farecast.operators.silver import load_bronze, tag_period, to_silver
from farecast.operators.sinks import (
    append,
    changes_since,
    compact,
    create_upsert_table,
    drop_table,
    ensure_database,
    latest,
    latest_of_table,
    materialize,
    replace_period,
    sql_over,
    table_exists,
    upsert,
    upsert_into,
)

__all__ = [
    "Run", "Scaler", "TrainResult", "append", "assign_trip_key", "bucketed_features", "changes_since", "compact",
    "create_upsert_table", "drop_table", "ensure_database", "evaluate", "fit_forest", "fit_scaler",
    "inverse_scale", "key_index", "latest", "latest_of_table", "left_join_features", "load_bronze", "load_run", "materialize",
    "model_matrix", "model_matrix_bucketed", "model_matrix_joined", "payment_flags", "pickup_hour", "predict_scaled", "read_metrics", "record_metrics",
    "replace_period", "sample_fraction", "save_run", "scale", "scaler_stats", "score", "split_exact", "split_hashed",
    "sql_over", "table_exists", "tag_period", "take_first", "to_silver", "train_run", "trip_key", "trip_key_compat",
    "upsert", "upsert_into", "with_row_index",
]
