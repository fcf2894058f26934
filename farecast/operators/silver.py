"""Bronze load tagging (P1) and the cleaned silver record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farecast.functions.codes import payment_label, provider_label, rate_label
from farecast.operators.keys import assign_trip_key, trip_key, with_file_index
from farecast.schemas import BRONZE, PERIOD_COLUMNS, SILVER, conform
from farecast.sources.files import FILE, ROW

# raw column -> silver column (matched case-insensitively)
RENAMES = {
    "VendorID": "provider_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "Passenger_count": "number_passenger",
    "Trip_distance": "trip_distance_miles",
    "PULocationID": "pickup_taxi_zone_id",
    "DOLocationID": "dropoff_taxi_zone_id",
    "RateCodeID": "rate_type",
    "Payment_type": "payment_type",
}


def tag_period(raw: DataFrame, year: int, month: int) -> DataFrame:
    """Add the literal load-period columns of one monthly file."""
    return raw.withColumns(
        {"metadata_year": F.lit(int(year)).cast("int"), "metadata_month": F.lit(int(month)).cast("int")}
    )


TRIP_ORDER = ("tpep_pickup_datetime", "event_id")


def load_bronze(
    raw: DataFrame,
    year: int | None = None,
    month: int | None = None,
    num_ranges: int | None = None,
    order_cols: Sequence[str] = TRIP_ORDER,
) -> DataFrame:
    """Bronze rows: raw + load period + trip key, assigned here once.

    With ``year``/``month`` the rows are one monthly file and are tagged with
    the literals; without, they must already carry the period columns.
    The key is assigned at load so that batch and stream share it. Rows are
    numbered in ``order_cols`` order, which must identify a row. Rows of one
    monthly file that carry their position in it (``read_trips``) are numbered
    by that position instead: no natural id, and no shuffle.
    """
    tagged = tag_period(raw, year, month) if year is not None else raw
    if year is not None and FILE in raw.columns:
        indexed = with_file_index(tagged, FILE, ROW, "__trip_index")
        return conform(indexed.withColumn("trip_id", trip_key(*PERIOD_COLUMNS, "__trip_index")), BRONZE)
    return conform(assign_trip_key(tagged, order_cols=order_cols, num_ranges=num_ranges), BRONZE)


def to_silver(bronze: DataFrame) -> DataFrame:
    """Rename, decode the coded columns and conform to the silver contract.

    A frame without ``trip_id`` is keyed first (rows of one or more periods
    with natural ids); frames that carry the key keep it.
    """
    df = bronze if "trip_id" in bronze.columns else assign_trip_key(bronze)
    df = df.withColumnsRenamed(RENAMES)
    df = df.withColumns(
        {
            "provider_id": provider_label(F.col("provider_id")),
            "rate_type": rate_label(F.col("rate_type")),
            "payment_type": payment_label(F.col("payment_type")),
        }
    )
    return conform(df, SILVER)
