"""Run by test_resilience.py in its own process: a local[4,3] session (each
task may fail and be retried), an input whose first task attempts fail, and
the keyed silver checked against a brute-force row_number."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def flaky(x: int) -> int:
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0:
        raise RuntimeError("injected failure of a first task attempt")
    return x


def main(sf_dir: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,3]")
        .config("spark.sql.shuffle.partitions", "6")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    from farecast.operators.silver import load_bronze, to_silver
    from farecast.sources.fixtures import events_table, raw_trips_from_events

    udf = F.udf(flaky, "long")
    events = events_table(spark, sf_dir).repartition(3, "event_id").withColumn("event_id", udf("event_id"))
    silver = to_silver(load_bronze(raw_trips_from_events(events)))
    got = {r["trip_id"] for r in silver.select("trip_id").collect()}
    raw = raw_trips_from_events(events_table(spark, sf_dir))
    w = Window.partitionBy("metadata_year", "metadata_month").orderBy("tpep_pickup_datetime", "event_id")
    want = {
        r["k"]
        for r in raw.select(
            (F.col("metadata_year").cast("long") * 10**14 + F.col("metadata_month").cast("long") * 10**12
             + F.row_number().over(w) - 1).alias("k")
        ).collect()
    }
    print("RESULT", "OK" if got == want and len(got) == raw.count() else f"MISMATCH {len(got)} {len(want)}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
