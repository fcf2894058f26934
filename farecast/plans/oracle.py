"""Equivalent ANSI SQL (DuckDB dialect) of the registered queries.

Written from the rules alone: nothing here comes from the code under test.
The adaptor's mappings and the labels are repeated as literals, the index is
a global ``row_number``, the hash is SQL's own md5. Outputs use double for
money and text for times.
"""

from __future__ import annotations

# fixed values: labels and codes of the original tables
PROVIDER_CODE_1 = "Creative Mobile Technologies"
PROVIDER_OTHER = "VeriFone Inc."
RATE_LABELS = {
    1: "standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "negotiated rate",
    6: "group_ride",
}
PAYMENT_LABELS = {
    1: "credit card",
    2: "cash",
    3: "no charge",
    4: "dispute",
    6: "voided trip",
}
PAYMENT_FLAG_LABELS = {
    "payment_cash": "cash",
    "payment_no_charge": "no charge",
    "payment_credit_card": "credit card",
    "payment_dispute": "dispute",
}
# fixed values of the adaptor
FIXTURE_YEAR = 2022
FIXTURE_MONTHS = {0: 1, 1: 11, 2: 12}
EVENT_PAYMENT = {"purchase": 1, "click": 2, "view": 3, "signup": 4}
ERROR_PAYMENT = {0: 5, 1: 6}
CONSTANT_MONEY = {
    "extra": "0.50",
    "mta_tax": "0.50",
    "improvement_surcharge": "0.30",
    "tolls_amount": "0.00",
    "congestion_surcharge": "2.50",
    "airport_fee": "0.00",
}

TS_FMT = "%Y-%m-%d %H:%M:%S.%f"
TOP_ROWS = 1000
HASH_RANGE = 16**15
TRAIN_FRACTION = 0.7


def hash_sql(salt: str, key: str = "trip_id") -> str:
    return f"CAST('0x' || substr(md5('{salt}|0|' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


def _case(key: str, mapping: dict, default: str = "NULL") -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    whens = " ".join(f"WHEN {key} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def _money(v: str) -> str:
    return f"CAST({v} AS DECIMAL(13,2))"


def raw_cte() -> str:
    payment = _case("event_type", EVENT_PAYMENT, default=f"CASE WHEN event_type = 'error' THEN {_case('event_id % 3', ERROR_PAYMENT)} END")
    tip = "CAST(CAST(10 * hour(ts) + 50 * (CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) + event_id % 100 AS DECIMAL(13,0)) / 100 AS DECIMAL(13,2))"
    consts = ",\n    ".join(f"{_money(v)} AS {c}" for c, v in CONSTANT_MONEY.items())
    total = " + ".join(["CAST(value AS DECIMAL(13,2))", tip, *[_money(v) for v in CONSTANT_MONEY.values()]])
    return f"""raw AS (
  SELECT event_id,
    CAST(user_id % 2 + 1 AS BIGINT) AS VendorID,
    ts AS tpep_pickup_datetime,
    ts + to_minutes(CAST(event_id % 60 AS BIGINT)) AS tpep_dropoff_datetime,
    CAST(event_id % 6 + 1 AS INTEGER) AS Passenger_count,
    CAST(value / 10 AS FLOAT) AS Trip_distance,
    CAST(user_id AS INTEGER) AS PULocationID,
    CAST(event_id % 150 AS INTEGER) AS DOLocationID,
    CAST(event_id % 7 + 1 AS INTEGER) AS RateCodeID,
    CAST({payment} AS INTEGER) AS Payment_type,
    CAST(value AS DECIMAL(13,2)) AS fare_amount,
    {tip} AS tip_amount,
    CAST({total} AS DECIMAL(13,2)) AS total_amount,
    {consts},
    CAST({FIXTURE_YEAR} AS INTEGER) AS metadata_year,
    CAST({_case('event_id % 3', FIXTURE_MONTHS)} AS INTEGER) AS metadata_month
  FROM events)"""


def indexed_cte() -> str:
    return """indexed AS (
  SELECT *, row_number() OVER (PARTITION BY metadata_year, metadata_month
                               ORDER BY tpep_pickup_datetime, event_id) - 1 AS idx
  FROM raw)"""


def bronze_cte() -> str:
    return """bronze AS (
  SELECT CAST(metadata_year AS BIGINT) * 100000000000000 + CAST(metadata_month AS BIGINT) * 1000000000000 + idx
         AS trip_id, *
  FROM indexed)"""


def silver_cte() -> str:
    provider = f"CASE WHEN VendorID = 1 THEN '{PROVIDER_CODE_1}' ELSE '{PROVIDER_OTHER}' END"
    return f"""silver AS (
  SELECT trip_id, metadata_year, metadata_month,
    {provider} AS provider_id,
    PULocationID AS pickup_taxi_zone_id,
    tpep_pickup_datetime AS pickup_datetime,
    DOLocationID AS dropoff_taxi_zone_id,
    tpep_dropoff_datetime AS dropoff_datetime,
    Passenger_count AS number_passenger,
    Trip_distance AS trip_distance_miles,
    {_case('RateCodeID', RATE_LABELS)} AS rate_type,
    {_case('Payment_type', PAYMENT_LABELS)} AS payment_type,
    fare_amount, extra, mta_tax, improvement_surcharge, tip_amount, tolls_amount,
    total_amount, congestion_surcharge, airport_fee
  FROM bronze)"""


def matrix_cte() -> str:
    flags = ",\n    ".join(f"coalesce(payment_type = '{v}', false) AS {c}" for c, v in PAYMENT_FLAG_LABELS.items())
    labels = ", ".join(f"'{v}'" for v in PAYMENT_FLAG_LABELS.values())
    return f"""matrix AS (
  SELECT trip_id, tip_amount, pickup_taxi_zone_id,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    {flags},
    NOT coalesce(payment_type IN ({labels}), false) AS payment_unknown
  FROM silver)"""


def sample_cte(n: int = TOP_ROWS) -> str:
    return f"""sample AS (
  SELECT * EXCLUDE (h) FROM (SELECT *, {hash_sql('top')} AS h FROM matrix)
  ORDER BY h, trip_id LIMIT {n})"""


def split_cte(fraction: float = TRAIN_FRACTION) -> str:
    return f"""ranked AS (
  SELECT *, row_number() OVER (ORDER BY {hash_sql('split')}, trip_id) AS rn, count(*) OVER () AS n FROM matrix),
split AS (
  SELECT * EXCLUDE (rn, n),
    CASE WHEN rn <= floor(CAST({fraction} AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS data_type
  FROM ranked)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


SILVER_CHAIN = (raw_cte(), indexed_cte(), bronze_cte(), silver_cte())
MATRIX_CHAIN = (*SILVER_CHAIN, matrix_cte())
SPLIT_CHAIN = (*MATRIX_CHAIN, split_cte())


def silver_select(table: str = "silver") -> str:
    return f"""SELECT trip_id, metadata_year, metadata_month, provider_id, pickup_taxi_zone_id,
  strftime(pickup_datetime, '{TS_FMT}') AS pickup_datetime, dropoff_taxi_zone_id,
  strftime(dropoff_datetime, '{TS_FMT}') AS dropoff_datetime, number_passenger,
  CAST(trip_distance_miles AS DOUBLE) AS trip_distance_miles, rate_type, payment_type,
  CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(extra AS DOUBLE) AS extra,
  CAST(mta_tax AS DOUBLE) AS mta_tax, CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge,
  CAST(tip_amount AS DOUBLE) AS tip_amount, CAST(tolls_amount AS DOUBLE) AS tolls_amount,
  CAST(total_amount AS DOUBLE) AS total_amount, CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge,
  CAST(airport_fee AS DOUBLE) AS airport_fee
FROM {table}"""


def _period_counts(table: str) -> str:
    return f"SELECT metadata_year, metadata_month, count(*) AS n FROM {table} GROUP BY metadata_year, metadata_month"


def _scaled_cte() -> str:
    return """stats AS (
  SELECT avg(CAST(tip_amount AS DOUBLE)) AS m, stddev_pop(CAST(tip_amount AS DOUBLE)) AS s FROM split),
scaled AS (
  SELECT split.*, (CAST(tip_amount AS DOUBLE) - m) / (CASE WHEN s = 0 OR s IS NULL THEN 1 ELSE s END) AS z
  FROM split, stats)"""


def oracle_queries() -> dict[str, str]:
    """DuckDB SQL per registered query key (none for forests, which have no SQL form)."""
    from math import ceil

    s = SILVER_CHAIN
    m = MATRIX_CHAIN
    sp = SPLIT_CHAIN
    raw_cols = """event_id, VendorID, strftime(tpep_pickup_datetime, '{f}') AS tpep_pickup_datetime,
  strftime(tpep_dropoff_datetime, '{f}') AS tpep_dropoff_datetime, Passenger_count,
  CAST(Trip_distance AS DOUBLE) AS Trip_distance, PULocationID, DOLocationID, RateCodeID,
  CAST(Payment_type AS VARCHAR) AS Payment_type,
  {money}, metadata_year, metadata_month""".format(
        f=TS_FMT,
        money=", ".join(
            f"CAST({c} AS DOUBLE) AS {c}"
            for c in ["fare_amount", "extra", "mta_tax", "improvement_surcharge", "tip_amount", "tolls_amount",
                      "total_amount", "congestion_surcharge", "airport_fee"]
        ),
    )
    matrix_cols = """trip_id, CAST(tip_amount AS DOUBLE) AS tip_amount, pickup_taxi_zone_id, pickup_hour,
  payment_cash, payment_no_charge, payment_credit_card, payment_dispute, payment_unknown"""
    train_t = min(HASH_RANGE, ceil(TRAIN_FRACTION * HASH_RANGE))
    frac_t = min(HASH_RANGE, ceil(0.25 * HASH_RANGE))
    upsert_amount = "CAST(tip_amount + CASE WHEN metadata_month IN (11, 12) THEN 1 ELSE 0 END AS DOUBLE)"
    return {
        "bronze_trips": with_ctes(raw_cte(), body=f"SELECT {raw_cols} FROM raw"),
        "row_index": with_ctes(raw_cte(), indexed_cte(), body="SELECT event_id, idx FROM indexed"),
        "trip_key": with_ctes(
            raw_cte(), indexed_cte(), bronze_cte(),
            body="""SELECT event_id, trip_id,
  CAST(CAST(metadata_year AS VARCHAR) || CAST(metadata_month AS VARCHAR) || CAST(idx AS VARCHAR) AS BIGINT)
    AS compat_id
FROM bronze""",
        ),
        "key_collisions": with_ctes(
            raw_cte(), indexed_cte(),
            body="""SELECT compat_id, count(*) AS n FROM (
  SELECT CAST(CAST(metadata_year AS VARCHAR) || CAST(metadata_month AS VARCHAR) || CAST(idx AS VARCHAR)
         AS BIGINT) AS compat_id FROM indexed) k
GROUP BY compat_id HAVING count(*) > 1""",
        ),
        "silver_trips": with_ctes(*s, body=silver_select()),
        "counts_by_period": with_ctes(*s, body=_period_counts("silver")),
        "total_count": with_ctes(*s, body="SELECT count(*) AS n FROM silver"),
        "pickup_hour": with_ctes(*s, body="SELECT trip_id, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour FROM silver"),
        "payment_flags": with_ctes(
            *m,
            body="""SELECT trip_id, payment_cash, payment_no_charge, payment_credit_card, payment_dispute,
  payment_unknown FROM matrix""",
        ),
        "matrix_joined": with_ctes(*m, body=f"SELECT {matrix_cols} FROM matrix"),
        "matrix_fused": with_ctes(*m, body=f"SELECT {matrix_cols} FROM matrix"),
        "sample_top_n": with_ctes(*m, sample_cte(), body=f"SELECT {matrix_cols} FROM sample"),
        "sample_fraction": with_ctes(*m, body=f"SELECT trip_id FROM matrix WHERE {hash_sql('sample')} < {frac_t}"),
        "split_exact": with_ctes(*sp, body="SELECT trip_id, data_type FROM split"),
        "split_hashed": with_ctes(
            *m,
            body=f"SELECT trip_id, CASE WHEN {hash_sql('split')} < {train_t} THEN 'train' ELSE 'test' END AS data_type FROM matrix",
        ),
        "train_rows": with_ctes(*sp, body="SELECT trip_id FROM split WHERE data_type = 'train'"),
        "scaler_stats": with_ctes(
            *sp,
            body="""SELECT 'all' AS fit_on, round(avg(CAST(tip_amount AS DOUBLE)), 6) AS mean,
  round(stddev_pop(CAST(tip_amount AS DOUBLE)), 6) AS std FROM split
UNION ALL
SELECT 'train' AS fit_on, round(avg(CAST(tip_amount AS DOUBLE)), 6) AS mean,
  round(stddev_pop(CAST(tip_amount AS DOUBLE)), 6) AS std FROM split WHERE data_type = 'train'""",
        ),
        "scaled_target": with_ctes(*sp, _scaled_cte(), body="SELECT trip_id, round(z, 6) AS z FROM scaled"),
        "inverse_scaled": with_ctes(*sp, body="SELECT trip_id, CAST(tip_amount AS DOUBLE) AS tip_amount FROM split"),
        "baseline_mse": with_ctes(
            *sp, _scaled_cte(),
            """hour_mean AS (
  SELECT pickup_hour, avg(z) AS hour_mean FROM scaled WHERE data_type = 'train' GROUP BY pickup_hour)""",
            "overall AS (SELECT avg(z) AS overall FROM scaled WHERE data_type = 'train')",
            body="""SELECT data_type, data_type || '_mean_square_error' AS metric,
  round(avg(power(z - coalesce(hour_mean, overall), 2)), 4) AS value
FROM scaled LEFT JOIN hour_mean USING (pickup_hour), overall
GROUP BY data_type""",
        ),
        "replace_period": with_ctes(*s, body=_period_counts("silver")),
        "append_table": with_ctes(*s, body="SELECT count(*) AS n FROM silver"),
        "upsert_latest": with_ctes(*s, body=f"SELECT trip_id, {upsert_amount} AS amount FROM silver"),
        "upsert_two_writers": with_ctes(
            *s,
            body="""SELECT trip_id,
  CAST(tip_amount + CASE metadata_month WHEN 1 THEN 0 WHEN 11 THEN 1 ELSE 2 END AS DOUBLE) AS amount FROM silver""",
        ),
        "tree_predictions": with_ctes(
            *sp,
            """means AS (
  SELECT pickup_hour, payment_cash, payment_no_charge, payment_credit_card, payment_dispute, payment_unknown,
    avg(CAST(tip_amount AS DOUBLE)) AS mean FROM split WHERE data_type = 'train' GROUP BY ALL)""",
            body="""SELECT trip_id, data_type, true AS has_value, round(mean, 6) AS predicted FROM split LEFT JOIN means
USING (pickup_hour, payment_cash, payment_no_charge, payment_credit_card, payment_dispute, payment_unknown)""",
        ),
        "exact_tree_metrics": with_ctes(
            *sp, _scaled_cte(),
            "hours AS (SELECT pickup_hour, avg(z) AS p FROM scaled WHERE data_type = 'train' GROUP BY pickup_hour)",
            body="""SELECT data_type, data_type || '_mean_square_error' AS metric, round(avg(power(z - p, 2)), 4) AS value
FROM scaled JOIN hours USING (pickup_hour) GROUP BY data_type""",
        ),
        "exact_tree_scores": with_ctes(
            *sp,
            """hours AS (SELECT pickup_hour, round(avg(CAST(tip_amount AS DOUBLE)), 2) AS p
  FROM split WHERE data_type = 'train' GROUP BY pickup_hour)""",
            body="SELECT trip_id, p AS predicted_tip_amount FROM matrix LEFT JOIN hours USING (pickup_hour)",
        ),
        "stream_progress": with_ctes(
            *s,
            body="""SELECT CAST(4 AS BIGINT) AS batches, count(*) AS rows, count(*) AS written,
  count(*) FILTER (metadata_month = 12) AS inserted, count(*) FILTER (metadata_month <> 12) AS updated FROM silver""",
        ),
        "stream_after_delete": with_ctes(*s, body=silver_select()),
        "matrix_bucketed": with_ctes(*m, body=f"SELECT {matrix_cols} FROM matrix"),
        "upsert_same_number": with_ctes(*s, body=f"SELECT trip_id, {upsert_amount} AS amount FROM silver"),
        "table_lifecycle": with_ctes(
            *s,
            body="""SELECT metadata_year, metadata_month, count(*) AS n, CAST(sum(tip_amount) AS DOUBLE) AS tips,
  false AS before, true AS after FROM silver GROUP BY metadata_year, metadata_month""",
        ),
        "materialized": with_ctes(*s, body=_period_counts("silver")),
        "stream_silver": with_ctes(*s, body=silver_select()),
        "apply_scalar": with_ctes(*s, body="SELECT trip_id, CAST(tip_amount AS DOUBLE) * 2 AS tip_doubled FROM silver"),
    }
