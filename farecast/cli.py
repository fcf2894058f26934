"""Command line for the flows, to run as a Spark application:

    spark-submit --py-files farecast.zip -m farecast.cli load  --landing L --year 2022 --month 11 --bronze B --silver S
    ... counts --silver S
    ... train  --silver S --runs R [--run-id ID] [--rows 50000] [--train 0.7] [--validation 0.0] [--fit-on all|train]
    ... score  --silver S --runs R --run-id ID --out P [--year Y --month M]
    ... stream --bronze B --runs R --run-id ID --silver-log SL --prediction-log PL --checkpoint C
               [--trigger availableNow|'10 seconds'] [--max-bytes BYTES | --max-files N] [--timeout SECONDS]
               [--tables LOG_ROOT --buckets N]   (logs as bucketed tables named SL and PL)

Each command prints one JSON line with what it did. All paths should be on
storage every executor can read (the cluster's shared file system).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from farecast.operators.keys import key_period
from farecast.operators.model import DEFAULT_TREES, load_run
from farecast.operators.sinks import create_upsert_table, replace_period
from farecast.schemas import PREDICTION, SILVER
from farecast.session import clear_scratch
from farecast.plans.flows import load_month, score_flow, train_flow
from farecast.sources.files import MONTHLY_FILE, read_table
from farecast.streaming.stream import await_progress, run_stream, scoring_batch, stream_trips


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="farecast")
    sub = p.add_subparsers(dest="cmd", required=True)

    load = sub.add_parser("load", help="load one monthly file into bronze and silver")
    load.add_argument("--landing", required=True)
    load.add_argument("--year", type=int, required=True)
    load.add_argument("--month", type=int, required=True)
    load.add_argument("--bronze", required=True)
    load.add_argument("--silver", required=True)
    load.add_argument("--file", default=MONTHLY_FILE, help="name pattern of the monthly file, with {year} and {month}")

    counts = sub.add_parser("counts", help="rows per load period of a table")
    counts.add_argument("--silver", required=True)

    train = sub.add_parser("train", help="sample, split, scale, fit and save a run")
    train.add_argument("--silver", required=True)
    train.add_argument("--runs", required=True)
    train.add_argument("--run-id")
    train.add_argument("--rows", type=int, default=50000)
    train.add_argument("--train", type=float, default=0.7)
    train.add_argument("--validation", type=float, default=0.0)
    train.add_argument("--fit-on", choices=["all", "train"], default="all")
    train.add_argument("--trees", type=int, default=DEFAULT_TREES)
    train.add_argument("--depth", type=int, help="depth limit (default: until leaves are pure)")

    score = sub.add_parser("score", help="score silver (or one period) with a saved run")
    score.add_argument("--silver", required=True)
    score.add_argument("--runs", required=True)
    score.add_argument("--run-id", required=True)
    score.add_argument("--out", required=True)
    score.add_argument("--year", type=int)
    score.add_argument("--month", type=int)

    stream = sub.add_parser("stream", help="stream bronze files into silver and prediction upsert logs")
    stream.add_argument("--bronze", required=True)
    stream.add_argument("--runs", required=True)
    stream.add_argument("--run-id", required=True)
    stream.add_argument("--silver-log", required=True)
    stream.add_argument("--prediction-log", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--trigger", default="availableNow")
    stream.add_argument("--max-files", type=int)
    stream.add_argument("--max-bytes", type=int, default=64 << 30, help="bound of a micro-batch without --max-files")
    stream.add_argument("--timeout", type=float)
    stream.add_argument("--tables", metavar="LOG_ROOT",
                        help="use bucketed upsert-log tables named by --silver-log/--prediction-log, "
                             "created below LOG_ROOT if absent")
    stream.add_argument("--buckets", type=int, default=64)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    own = spark is None  # an application of its own clears its intermediate tables when it is done
    spark = spark or SparkSession.builder.appName(f"farecast-{args.cmd}").getOrCreate()
    if args.cmd == "load":
        silver = load_month(spark, args.landing, args.year, args.month, args.bronze, args.silver, template=args.file)
        out = {"period": [args.year, args.month], "rows": silver.count()}
    elif args.cmd == "counts":
        rows = read_table(spark, args.silver).groupBy("metadata_year", "metadata_month").count().collect()
        out = {"counts": sorted([r[0], r[1], r[2]] for r in rows)}
    elif args.cmd == "train":
        result = train_flow(read_table(spark, args.silver), args.runs, args.run_id, args.rows, args.train,
                            args.fit_on, args.trees, args.depth, args.validation)
        out = {"run_id": result.run.run_id, "metrics": {r["metric"]: r["value"] for r in result.metrics.collect()}}
    elif args.cmd == "score":
        period = (args.year, args.month) if args.year is not None and args.month is not None else None
        silver = read_table(spark, args.silver, period)
        preds = score_flow(silver, load_run(spark, args.runs, args.run_id))
        year, month = key_period("trip_id")  # the padded key carries its period: no join back
        replace_period(preds.withColumns({"metadata_year": year, "metadata_month": month}), args.out, period=period)
        out = {"run_id": args.run_id, "rows": read_table(spark, args.out, period).count()}
    else:
        run = load_run(spark, args.runs, args.run_id)
        if args.tables:
            root = args.tables.rstrip("/")
            create_upsert_table(spark, args.silver_log, SILVER, f"{root}/silver_log", buckets=args.buckets)
            create_upsert_table(spark, args.prediction_log, PREDICTION, f"{root}/prediction_log", buckets=args.buckets)
        query = run_stream(
            stream_trips(spark, args.bronze, max_files=args.max_files, max_bytes=args.max_bytes),
            scoring_batch(args.silver_log, args.prediction_log, run, table=bool(args.tables)),
            args.checkpoint,
            args.trigger,
        )
        p = await_progress(query, args.timeout)
        out = {"batches": p.batches, "rows": p.rows, "finished": p.finished}
    print(json.dumps(out))
    if own:
        clear_scratch(spark)
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
    sys.exit(0)
