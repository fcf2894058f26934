"""Features (P11-P13, F3) and the model matrix (J1 / fused projection).

Features are ``DataFrame -> DataFrame`` functions over the silver record.
``model_matrix`` computes all of them in one projection of silver -- no join,
no shuffle -- which equals the keyed left joins of the separate feature frames
because ``trip_id`` is unique and non-null. ``model_matrix_joined`` keeps the
join form for features that come from other tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farecast.functions.codes import PAYMENT_FLAG_LABELS
from farecast.operators.joins import bucketed_features, left_join_features
from farecast.schemas import MATRIX, PAYMENT, PICKUP_HOUR, conform


def pickup_hour_col(ts: str = "pickup_datetime") -> Column:
    return F.hour(F.col(ts)).cast("int")


def payment_flag_cols(payment: str = "payment_type") -> dict[str, Column]:
    """The four label flags (NULL -> false) and ``payment_unknown`` (NULL -> true)."""
    p = F.col(payment)
    flags = {name: p.eqNullSafe(F.lit(label)) for name, label in PAYMENT_FLAG_LABELS.items()}
    flags["payment_unknown"] = ~F.coalesce(p.isin(*PAYMENT_FLAG_LABELS.values()), F.lit(False))
    return flags


def pickup_hour(silver: DataFrame) -> DataFrame:
    """(trip_id, pickup_hour)."""
    return conform(silver.select("trip_id", pickup_hour_col().alias("pickup_hour")), PICKUP_HOUR)


def payment_flags(silver: DataFrame) -> DataFrame:
    """(trip_id, payment_cash, payment_no_charge, payment_credit_card, payment_dispute, payment_unknown)."""
    return conform(silver.select("trip_id", *[c.alias(n) for n, c in payment_flag_cols().items()]), PAYMENT)


def model_matrix(silver: DataFrame) -> DataFrame:
    """Model matrix in one projection of silver (no join)."""
    return conform(
        silver.select(
            "trip_id",
            "tip_amount",
            "pickup_taxi_zone_id",
            pickup_hour_col().alias("pickup_hour"),
            *[c.alias(n) for n, c in payment_flag_cols().items()],
        ),
        MATRIX,
    )


def model_matrix_joined(silver: DataFrame, hour: DataFrame | None = None, payment: DataFrame | None = None) -> DataFrame:
    """Model matrix as silver left-joined with the feature frames on trip_id."""
    base = silver.select("trip_id", "tip_amount", "pickup_taxi_zone_id")
    hour = pickup_hour(silver) if hour is None else hour
    payment = payment_flags(silver) if payment is None else payment
    return conform(left_join_features(left_join_features(base, hour), payment), MATRIX)


def model_matrix_bucketed(silver: DataFrame, root: str, prefix: str, buckets: int = 64) -> DataFrame:
    """The joined matrix from tables bucketed by trip_id below ``root`` (named ``prefix`` + ...): each
    frame is shuffled once, when it is written, and joins read bucket by bucket without an exchange."""
    frames = {
        "base": silver.select("trip_id", "tip_amount", "pickup_taxi_zone_id"),
        "hour": pickup_hour(silver),
        "payment": payment_flags(silver),
    }
    tables = {k: bucketed_features(f, f"{prefix}_{k}", f"{root.rstrip('/')}/{k}", buckets=buckets) for k, f in frames.items()}
    return model_matrix_joined(tables["base"], tables["hour"].hint("merge"), tables["payment"].hint("merge"))
