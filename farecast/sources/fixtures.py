"""Adaptor from the shared test table ``events`` to raw monthly trips.

The taxi files are not available, so every raw trip column is derived from
one ``events`` row by a fixed rule (the same rule is written in SQL for the
oracle in ``farecast.plans.oracle``). Money values are whole cents, so the
decimal casts never meet a half cent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farecast.schemas import MONEY, RAW, conform
from farecast.session import list_names, move_path, remove_path
from farecast.sources.files import MONTHLY_FILE

# --- fixed values of the adaptor ---------------------------------------------
FIXTURE_YEAR = 2022
# event_id % 3 -> month of the monthly file the row is landed in
FIXTURE_MONTHS = {0: 1, 1: 11, 2: 12}
# event type -> payment code; "error" becomes 5, 6 or NULL by event_id % 3
EVENT_PAYMENT = {"purchase": 1, "click": 2, "view": 3, "signup": 4}
ERROR_PAYMENT = {0: 5, 1: 6}
# constant money columns
CONSTANT_MONEY = {
    "extra": "0.50",
    "mta_tax": "0.50",
    "improvement_surcharge": "0.30",
    "tolls_amount": "0.00",
    "congestion_surcharge": "2.50",
    "airport_fee": "0.00",
}
# -----------------------------------------------------------------------------


def _case(key: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    return expr


def _cents(expr: Column) -> Column:
    """integer cents -> decimal(13,2), exactly."""
    return (expr.cast("decimal(13,0)") / F.lit(100)).cast(MONEY)


def raw_trips_from_events(events: DataFrame) -> DataFrame:
    """Raw trip columns (``RAW``) plus the period the row is landed in."""
    e = F.col("event_id")
    etype = F.col("event_type")
    payment = _case(etype, EVENT_PAYMENT).when(etype == F.lit("error"), _case(F.pmod(e, F.lit(3)), ERROR_PAYMENT))
    purchase = F.when(etype == F.lit("purchase"), F.lit(1)).otherwise(F.lit(0))
    tip = _cents(F.lit(10) * F.hour("ts") + F.lit(50) * purchase + F.pmod(e, F.lit(100)))
    fare = F.col("value").cast(MONEY)
    consts = {c: F.lit(v).cast(MONEY) for c, v in CONSTANT_MONEY.items()}
    total = fare + tip
    for c in consts.values():
        total = total + c

    cols = {
        "event_id": e,
        "VendorID": F.pmod(F.col("user_id"), F.lit(2)) + F.lit(1),
        "tpep_pickup_datetime": F.col("ts"),
        "tpep_dropoff_datetime": F.timestamp_add("MINUTE", F.pmod(e, F.lit(60)), F.col("ts")),
        "Passenger_count": F.pmod(e, F.lit(6)) + F.lit(1),
        "Trip_distance": F.col("value") / F.lit(10),
        "PULocationID": F.col("user_id"),
        "DOLocationID": F.pmod(e, F.lit(150)),
        "RateCodeID": F.pmod(e, F.lit(7)) + F.lit(1),
        "Payment_type": payment,
        "fare_amount": fare,
        "tip_amount": tip,
        "total_amount": total,
        **consts,
    }
    raw = conform(events.select(*[v.alias(k) for k, v in cols.items()]), RAW)
    return raw.withColumns(
        {
            "metadata_year": F.lit(FIXTURE_YEAR).cast("int"),
            "metadata_month": _case(F.pmod(F.col("event_id"), F.lit(3)), FIXTURE_MONTHS).cast("int"),
        }
    )


def fixture_periods() -> list[tuple[int, int]]:
    return [(FIXTURE_YEAR, m) for m in sorted(set(FIXTURE_MONTHS.values()))]


def land_monthly(raw_with_period: DataFrame, root: str) -> list[tuple[int, int]]:
    """Write each period's raw rows as one monthly file below ``root``, named
    as the published monthly files are, in one pass. Returns the periods written."""
    spark, root = raw_with_period.sparkSession, root.rstrip("/")
    name = F.format_string(
        MONTHLY_FILE.replace("{year}", "%d").replace("{month:02d}", "%02d"), "metadata_year", "metadata_month"
    )
    staged = f"{root}/_staged"
    raw_with_period.select(*conform(raw_with_period, RAW).columns, name.alias("file")).write.mode("overwrite").partitionBy(
        "file"
    ).parquet(staged)
    for folder in list_names(spark, staged):
        if folder.startswith("file="):
            move_path(spark, f"{staged}/{folder}", f"{root}/{folder.removeprefix('file=')}")
    remove_path(spark, staged)
    return fixture_periods()


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
