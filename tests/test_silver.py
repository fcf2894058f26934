"""Codes, labels, features, schema contract."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from farecast.operators.features import model_matrix, model_matrix_joined, payment_flags, pickup_hour
from farecast.operators.silver import to_silver
from farecast.schemas import BRONZE, SILVER
from farecast.sources.files import trips_from_rows


def _bronze_rows(spark, codes):
    """codes: list of (trip_id, VendorID, RateCodeID, Payment_type)."""
    ts = dt.datetime(2022, 11, 1, 0, 51, 22)
    rows = []
    for tid, vendor, rate, pay in codes:
        r = {f.name: None for f in BRONZE.fields}
        r.update(
            trip_id=tid, event_id=tid, VendorID=vendor, RateCodeID=rate, Payment_type=pay,
            tpep_pickup_datetime=ts, tpep_dropoff_datetime=ts, metadata_year=2022, metadata_month=11,
            tip_amount=Decimal("1.00"),
        )
        rows.append(tuple(r[f.name] for f in BRONZE.fields))
    return spark.createDataFrame(rows, BRONZE)


def test_provider_labels_every_branch(spark):
    df = to_silver(_bronze_rows(spark, [(1, 1, 1, 1), (2, 2, 1, 1), (3, None, 1, 1), (4, 9, 1, 1)]))
    got = dict(df.select("trip_id", "provider_id").collect())
    assert got == {
        1: "Creative Mobile Technologies",
        2: "VeriFone Inc.",
        3: "VeriFone Inc.",  # NULL falls to the otherwise branch
        4: "VeriFone Inc.",
    }


def test_rate_labels_every_branch(spark):
    codes = [(i, 1, rate, 1) for i, rate in enumerate([1, 2, 3, 4, 5, 6, 7, None], start=1)]
    got = dict(to_silver(_bronze_rows(spark, codes)).select("trip_id", "rate_type").collect())
    assert got == {
        1: "standard rate", 2: "JFK", 3: "Newark", 4: "Nassau/Westchester",
        5: "negotiated rate", 6: "group_ride", 7: None, 8: None,
    }


def test_payment_labels_every_branch(spark):
    codes = [(i + 1, 1, 1, pay) for i, pay in enumerate([0, 1, 2, 3, 4, 5, 6, None])]
    got = dict(to_silver(_bronze_rows(spark, codes)).select("trip_id", "payment_type").collect())
    assert got == {
        1: None, 2: "credit card", 3: "cash", 4: "no charge", 5: "dispute", 6: None, 7: "voided trip", 8: None,
    }


def test_silver_contract(spark):
    df = to_silver(_bronze_rows(spark, [(1, 1, 1, 1)]))
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in SILVER.fields]


def test_payment_flags_null_and_voided(spark):
    rows = [
        {"trip_id": i, "payment_type": p}
        for i, p in enumerate(["cash", "no charge", "credit card", "dispute", "voided trip", None], start=1)
    ]
    flags = {r["trip_id"]: r for r in payment_flags(trips_from_rows(spark, rows)).collect()}
    assert flags[1]["payment_cash"] and not flags[1]["payment_unknown"]
    assert flags[2]["payment_no_charge"] and flags[3]["payment_credit_card"] and flags[4]["payment_dispute"]
    for i in (5, 6):  # voided trip and NULL: all four false, unknown true, never NULL
        r = flags[i]
        assert [r["payment_cash"], r["payment_no_charge"], r["payment_credit_card"], r["payment_dispute"]] == [
            False, False, False, False,
        ]
        assert r["payment_unknown"] is True


def test_literal_row_features(spark):
    """The one literal scoring row: hour 0, credit card, other flags false."""
    row = {
        "trip_id": 2022110, "metadata_year": 2022, "metadata_month": 11,
        "provider_id": "Creative Mobile Technologies", "pickup_taxi_zone_id": 50,
        "pickup_datetime": dt.datetime(2022, 11, 1, 0, 51, 22), "dropoff_taxi_zone_id": 50,
        "dropoff_datetime": dt.datetime(2022, 11, 1, 0, 56, 24), "number_passenger": 1,
        "trip_distance_miles": 0.6000000238418579, "rate_type": "standard rate", "payment_type": "credit card",
        "fare_amount": Decimal("4.50"), "extra": Decimal("0.50"), "mta_tax": Decimal("0.50"),
        "improvement_surcharge": Decimal("0.30"), "tip_amount": Decimal("0.00"), "tolls_amount": Decimal("0.00"),
        "total_amount": Decimal("5.80"), "congestion_surcharge": Decimal("0.00"), "airport_fee": Decimal("0.00"),
    }
    m = model_matrix(trips_from_rows(spark, [row])).collect()[0]
    assert m["pickup_hour"] == 0 and m["payment_credit_card"] is True
    assert not (m["payment_cash"] or m["payment_no_charge"] or m["payment_dispute"] or m["payment_unknown"])
    assert pickup_hour(trips_from_rows(spark, [row])).collect()[0]["pickup_hour"] == 0


def test_fused_matrix_equals_joined(spark):
    from farecast.plans.catalog import saved_silver
    from tests.conftest import SMALL

    silver = saved_silver(spark, SMALL)
    fused, joined = model_matrix(silver), model_matrix_joined(silver)
    assert [(f.name, f.dataType) for f in fused.schema] == [(f.name, f.dataType) for f in joined.schema]
    assert fused.exceptAll(joined).count() == 0 and joined.exceptAll(fused).count() == 0
    assert fused.count() == silver.count()


def test_trip_ids_unique(spark):
    from farecast.plans.catalog import saved_silver
    from tests.conftest import SMALL

    silver = saved_silver(spark, SMALL)
    assert silver.groupBy("trip_id").count().where(F.col("count") > 1).count() == 0
    assert silver.where(F.col("trip_id").isNull()).count() == 0
