"""The command line, run in-process on the test session."""

from __future__ import annotations

from pyspark.sql import functions as F

from farecast.cli import main
from farecast.operators.keys import key_period, trip_key
from farecast.sources.files import read_table
from farecast.sources.fixtures import events_table, land_monthly, raw_trips_from_events
from tests.conftest import SMALL


def test_key_period_inverts_the_padded_key(spark):
    df = spark.createDataFrame([(2022, 1, 0), (2022, 11, 999999999999), (2023, 12, 5)], "y int, m int, i long")
    year, month = key_period("k")
    got = df.select(trip_key("y", "m", "i").alias("k"), "y", "m").select(year.alias("y2"), month.alias("m2"), "y", "m")
    assert got.where((F.col("y") != F.col("y2")) | (F.col("m") != F.col("m2"))).count() == 0


def test_cli_load_train_score_stream(spark, scratch):
    landing, bronze, silver, runs, out = (scratch(x) for x in ("land", "bronze", "silver", "runs", "out"))
    raw = raw_trips_from_events(events_table(spark, SMALL))
    land_monthly(raw, landing)
    for m in (1, 11, 12):
        main(["load", "--landing", landing, "--year", "2022", "--month", str(m), "--bronze", bronze, "--silver", silver], spark)
    counts = main(["counts", "--silver", silver], spark)["counts"]
    assert sum(c[2] for c in counts) == raw.count() and len(counts) == 3
    trained = main(["train", "--silver", silver, "--runs", runs, "--trees", "5", "--depth", "4"], spark)
    assert set(trained["metrics"]) == {"train_mean_square_error", "test_mean_square_error"}
    three = main(["train", "--silver", silver, "--runs", runs, "--trees", "3", "--depth", "3",
                  "--train", "0.6", "--validation", "0.2"], spark)
    assert set(three["metrics"]) == {"train_mean_square_error", "validation_mean_square_error", "test_mean_square_error"}
    scored = main(["score", "--silver", silver, "--runs", runs, "--run-id", trained["run_id"], "--out", out], spark)
    assert scored["rows"] == raw.count()
    one = main(["score", "--silver", silver, "--runs", runs, "--run-id", trained["run_id"], "--out", out,
                "--year", "2022", "--month", "11"], spark)
    assert one["rows"] == raw.where(F.col("metadata_month") == 11).count()
    # a period that was emptied loses its old predictions, and only that one does
    nov = ["--runs", runs, "--run-id", trained["run_id"], "--out", out, "--year", "2022", "--month", "11"]
    emptied = scratch("emptied")
    read_table(spark, silver).where("metadata_month <> 11").write.partitionBy("metadata_year", "metadata_month").parquet(emptied)
    assert main(["score", "--silver", emptied, *nov], spark)["rows"] == 0
    assert read_table(spark, out).count() == raw.where(F.col("metadata_month") != 11).count()
    main(["score", "--silver", silver, *nov], spark)
    assert read_table(spark, out).count() == raw.count()
    streamed = main(["stream", "--bronze", bronze, "--runs", runs, "--run-id", trained["run_id"],
                     "--silver-log", scratch("sl"), "--prediction-log", scratch("pl"), "--checkpoint", scratch("ck"),
                     "--max-files", "100", "--timeout", "300"], spark)
    assert streamed["rows"] == raw.count() and streamed["finished"]
    from farecast.operators.sinks import drop_table, latest_of_table

    for t in ("cli_silver_log", "cli_pred_log"):
        drop_table(spark, t)
    tabled = main(["stream", "--bronze", bronze, "--runs", runs, "--run-id", trained["run_id"],
                   "--silver-log", "cli_silver_log", "--prediction-log", "cli_pred_log", "--checkpoint", scratch("ck"),
                   "--max-files", "100", "--timeout", "300", "--tables", scratch("logs"), "--buckets", "4"], spark)
    assert tabled["rows"] == raw.count()
    assert latest_of_table(spark, "cli_pred_log").count() == raw.count()
