"""Fixed schemas of every frame, and ``conform`` to enforce them.

A schema is a contract: ``conform(df, SCHEMA)`` keeps exactly the declared
columns, in order, cast to the declared types. Column descriptions live in
the field metadata so that they travel with written tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(13, 2)


def _f(name: str, dtype: T.DataType, comment: str = "") -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": comment} if comment else {})


MONEY_COLUMNS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "improvement_surcharge",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
]

# fixed values: names and order of the raw file's columns (RAW) and of the cleaned record (SILVER).
# Raw monthly trip file as landed (bronze input). `event_id` is the natural id
# of the source row; it makes the row order, and so the key, stable.
RAW = T.StructType(
    [
        _f("event_id", T.LongType(), "natural id of the source row"),
        _f("VendorID", T.LongType()),
        _f("tpep_pickup_datetime", T.TimestampNTZType()),
        _f("tpep_dropoff_datetime", T.TimestampNTZType()),
        _f("Passenger_count", T.IntegerType()),
        _f("Trip_distance", T.FloatType()),
        _f("PULocationID", T.IntegerType()),
        _f("DOLocationID", T.IntegerType()),
        _f("RateCodeID", T.IntegerType()),
        _f("Payment_type", T.IntegerType()),
        *[_f(c, MONEY) for c in MONEY_COLUMNS],
    ]
)

PERIOD_COLUMNS = ["metadata_year", "metadata_month"]

BRONZE = T.StructType(
    [
        _f("trip_id", T.LongType(), "surrogate key, assigned once at load"),
        *RAW.fields,
        _f("metadata_year", T.IntegerType(), "year of the loaded file"),
        _f("metadata_month", T.IntegerType(), "month of the loaded file"),
    ]
)

SILVER = T.StructType(
    [
        _f("trip_id", T.LongType(), "key of the trip"),
        _f("metadata_year", T.IntegerType(), "year of the load"),
        _f("metadata_month", T.IntegerType(), "month of the load"),
        _f("provider_id", T.StringType(), "who sent the record"),
        _f("pickup_taxi_zone_id", T.IntegerType(), "zone of the start"),
        _f("pickup_datetime", T.TimestampNTZType(), "start of the trip"),
        _f("dropoff_taxi_zone_id", T.IntegerType(), "zone of the end"),
        _f("dropoff_datetime", T.TimestampNTZType(), "end of the trip"),
        _f("number_passenger", T.IntegerType(), "passengers on board"),
        _f("trip_distance_miles", T.FloatType(), "miles driven"),
        _f("rate_type", T.StringType(), "label of the rate code"),
        _f("payment_type", T.StringType(), "label of the payment code"),
        *[_f(c, MONEY) for c in MONEY_COLUMNS],
    ]
)

# fixed values: the model's input features, in this order
FEATURES = [
    "pickup_hour",
    "pickup_taxi_zone_id",
    "payment_cash",
    "payment_no_charge",
    "payment_credit_card",
    "payment_dispute",
    "payment_unknown",
]

PAYMENT_FLAGS = FEATURES[2:]

PICKUP_HOUR = T.StructType([_f("trip_id", T.LongType()), _f("pickup_hour", T.IntegerType(), "0 to 23")])

PAYMENT = T.StructType([_f("trip_id", T.LongType()), *[_f(c, T.BooleanType()) for c in PAYMENT_FLAGS]])

MATRIX = T.StructType(
    [
        _f("trip_id", T.LongType()),
        _f("tip_amount", MONEY),
        _f("pickup_taxi_zone_id", T.IntegerType()),
        _f("pickup_hour", T.IntegerType()),
        *[_f(c, T.BooleanType()) for c in PAYMENT_FLAGS],
    ]
)

SPLIT = T.StructType([MATRIX["trip_id"], _f("data_type", T.StringType(), "train or test"), *MATRIX.fields[1:]])

METRICS = T.StructType(
    [_f("data_type", T.StringType()), _f("metric", T.StringType()), _f("value", T.DoubleType())]
)

SCALED_PREDICTION = T.StructType([_f("trip_id", T.LongType()), _f("scaled_predicted_tip_amount", T.DoubleType())])

PREDICTION = T.StructType([_f("trip_id", T.LongType()), _f("predicted_tip_amount", MONEY, "tip that the model expects")])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Prune to the declared columns, in declared order, cast to declared types."""
    cols: list[Column] = [
        F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields
    ]
    return df.select(*cols)
