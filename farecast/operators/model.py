"""Random-forest tip model.

The forest of a run is fitted on a bounded sample of its train rows, one tree
a task (``farecast.operators.forest``); ``fit_rows=None`` fits Spark ML's
distributed forest on all train rows instead. Scoring, evaluation and scaling
run over all rows: scoring predicts every distinct combination of features
once and joins the predictions on, metrics are one grouped aggregate. A run
directory holds model, scaler and metrics; a marker written last makes it
visible.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.operators import forest
from farecast.operators.forest import Forest
from farecast.operators.sampling import take_first
from farecast.operators.scaling import Scaler, fit_scaler, inverse_scale, scale
from farecast.schemas import FEATURES, METRICS, PREDICTION, SCALED_PREDICTION, conform
from farecast.session import path_exists, remove_path, touch

# fixed values of the original model setup; trees grow until their leaves are pure
SEED = 12345
DEFAULT_TREES = 100
FIT_ROWS = 50_000  # at most so many train rows fit the forest (the first of the hash order)
LABEL = "tip_amount"
PREDICTED = "tip_amount_predicted"
PUBLISHED = "_PUBLISHED"

# Spark ML's forest: its deepest trees, and bins for every zone
ML_DEPTH = 30
ML_BINS = 512

Model = Forest | PipelineModel


@dataclass
class Run:
    run_id: str
    root: str
    model: Model
    scaler: Scaler

    @property
    def path(self) -> str:
        return run_path(self.root, self.run_id)


def run_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{run_id}"


def model_inputs(df: DataFrame) -> DataFrame:
    """Integer narrowing of the model inputs (P14); flags stay boolean."""
    return df.withColumns({"pickup_hour": F.col("pickup_hour").cast("int"),
                           "pickup_taxi_zone_id": F.col("pickup_taxi_zone_id").cast("int")})


def forest_pipeline(
    num_trees: int = DEFAULT_TREES,
    max_depth: int | None = None,
    seed: int = SEED,
    label: str = LABEL,
    features: list[str] = FEATURES,
    **options,
) -> Pipeline:
    """Feature packing (P15) + Spark ML's distributed forest; ``options`` go to the forest.

    Node ids are cached, so that a stage is not sent the whole growing forest."""
    options = {"featureSubsetStrategy": "all", "maxBins": ML_BINS, "cacheNodeIds": True, **options}
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"),
            RandomForestRegressor(
                featuresCol="features", labelCol=label, predictionCol="prediction",
                numTrees=num_trees, maxDepth=ML_DEPTH if max_depth is None else max_depth, seed=seed, **options,
            ),
        ]
    )


def fit_forest(
    scaled_split: DataFrame,
    num_trees: int = DEFAULT_TREES,
    max_depth: int | None = None,
    seed: int = SEED,
    fit_rows: int | None = FIT_ROWS,
    features: list[str] = FEATURES,
    bootstrap: bool = True,
    **options,
) -> Model:
    """Fit on the 'train' rows of a scaled split (F1 + L2).

    The trees see at most ``fit_rows`` rows, those first in the hash order, and each draws a bootstrap
    of them. Without ``bootstrap`` equal feature rows are the same to a tree, so they are counted and
    averaged first, over *all* train rows; ``fit_rows`` then bounds the distinct ones.
    ``fit_rows=None`` takes Spark ML's forest on all rows (``options`` are its parameters)."""
    train = model_inputs(scaled_split.where(F.col("data_type") == F.lit("train")))
    if fit_rows is None:
        return forest_pipeline(num_trees, max_depth, seed, features=features, bootstrap=bootstrap, **options).fit(train)
    if options:
        raise TypeError(f"only Spark ML's forest (fit_rows=None) takes {sorted(options)}")
    if bootstrap:
        arrays = forest.sample_arrays(take_first(train, fit_rows), features, LABEL, None, ["trip_id"])
    else:
        y = F.col(LABEL).cast("double")
        cells = train.groupBy(*features).agg(F.avg(y).alias("__mean"), F.count(F.lit(1)).alias("__rows"))
        arrays = forest.sample_arrays(cells.limit(fit_rows + 1), features, "__mean", "__rows", features)
        if len(arrays[1]) > fit_rows:
            raise ValueError(f"more than {fit_rows} distinct feature rows: fit Spark ML's forest (fit_rows=None)")
    return forest.fit(train.sparkSession, *arrays, features, num_trees, max_depth, seed, bootstrap)


def predict_scaled(model: Model, df: DataFrame, out: str = "scaled_predicted_tip_amount") -> DataFrame:
    """Scaled prediction for every row (L3/L4), other columns kept."""
    keep = df.columns
    return model.transform(model_inputs(df)).select(*keep, F.col("prediction").cast("double").alias(out))


def evaluate(pred: DataFrame, label: str = LABEL, predicted: str = PREDICTED, with_r2: bool = False) -> DataFrame:
    """Mean squared error per data_type, rounded to 4 digits.

    One row per split present; a split without rows yields no row. With
    ``with_r2`` each split also gets ``<split>_r2`` = 1 - MSE / Var(label)
    (NULL for a constant label), from the same single aggregate.
    """
    y = F.col(label).cast("double")
    err = F.pow(y - F.col(predicted).cast("double"), 2)
    stats = pred.groupBy("data_type").agg(F.avg(err).alias("mse"), F.var_pop(y).alias("var"))
    rows = [F.struct(F.lit("_mean_square_error").alias("suffix"), F.round("mse", 4).alias("value"))]
    if with_r2:
        r2 = F.when(F.col("var") > 0, F.lit(1.0) - F.col("mse") / F.col("var"))
        rows.append(F.struct(F.lit("_r2").alias("suffix"), F.round(r2, 4).alias("value")))
    long = stats.select("data_type", F.inline(F.array(*rows)))
    return conform(long.withColumn("metric", F.concat(F.col("data_type"), F.col("suffix"))), METRICS)


def save_run(run: Run, metrics: DataFrame | None = None) -> Run:
    """Write model, scaler and metrics of a run (K8, K9), then publish it.

    The run is invisible to ``load_run`` until everything is there: the marker is removed first and
    written last, so a save that dies leaves an unfinished run and never a mixed one."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    remove_path(spark, f"{run.path}/{PUBLISHED}")
    remove_path(spark, f"{run.path}/model")
    if isinstance(run.model, Forest):
        run.model.save(spark, f"{run.path}/model")
    else:
        run.model.write().overwrite().save(f"{run.path}/model")
    spark.createDataFrame([(run.scaler.mean, run.scaler.std)], "mean double, std double").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{run.path}/scaler")
    if metrics is not None:
        record_metrics(metrics, run.root, run.run_id)
    touch(spark, f"{run.path}/{PUBLISHED}")
    return run


def load_run(spark: SparkSession, root: str, run_id: str) -> Run:
    """Model and scaler of one published run (S8); loaded once. An unfinished run is refused."""
    path = run_path(root, run_id)
    if not path_exists(spark, f"{path}/{PUBLISHED}"):
        raise FileNotFoundError(f"no published run {run_id} below {root}")
    row = spark.read.parquet(f"{path}/scaler").first()
    own = path_exists(spark, f"{path}/model/trees")
    model = Forest.load(spark, f"{path}/model") if own else PipelineModel.load(f"{path}/model")
    return Run(run_id, root, model, Scaler(float(row["mean"]), float(row["std"])))


def record_metrics(metrics: DataFrame, root: str, run_id: str) -> DataFrame:
    """Write the run's metric rows below ``root/metrics`` (K9) and return them
    as read back. One partition per run: recording a run again replaces it."""
    metrics.write.mode("overwrite").parquet(f"{root.rstrip('/')}/metrics/run_id={run_id}")
    return read_metrics(metrics.sparkSession, root, run_id)


def read_metrics(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """Recorded metrics: of one run, or of all with their ``run_id``."""
    path = f"{root.rstrip('/')}/metrics"
    if run_id is not None:
        return spark.read.schema(METRICS).parquet(f"{path}/run_id={run_id}")
    return spark.read.schema(T.StructType([*METRICS.fields, T.StructField("run_id", T.StringType())])).parquet(path)


@dataclass
class TrainResult:
    run: Run
    predictions: DataFrame  # trip_id, data_type, tip_amount (scaled), tip_amount_predicted
    metrics: DataFrame


def train_run(
    split: DataFrame,
    root: str,
    run_id: str | None = None,
    fit_on: str = "all",
    num_trees: int = DEFAULT_TREES,
    max_depth: int | None = None,
    seed: int = SEED,
    save: bool = True,
    with_r2: bool = False,
    partitions: int | None = None,
    fit_rows: int | None = FIT_ROWS,
    **options,
) -> TrainResult:
    """Scale, fit, predict on train + test, evaluate, save.

    The split is checkpointed to the shared folder: scaler, forest and
    predictions read it, and its plan should run once and survive a lost
    executor. Spark ML's forest (``fit_rows=None``) follows the placement of
    rows, so for it they are spread over ``partitions`` tasks by a hash of
    trip_id first, the same on every run.
    """
    run_id = run_id or uuid.uuid4().hex
    spark = split.sparkSession
    if fit_rows is None:
        split = split.repartition(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), "trip_id")
    split = split.checkpoint(eager=True)
    scaler = fit_scaler(split, LABEL, fit_on)
    scaled = scale(split, scaler, LABEL)
    model = fit_forest(scaled, num_trees, max_depth, seed, fit_rows, **options)
    run = Run(run_id, root, model, scaler)
    pred = predict_scaled(model, scaled, PREDICTED).select("trip_id", "data_type", LABEL, PREDICTED)
    metrics = evaluate(pred, with_r2=with_r2)
    if save:
        save_run(run, metrics)
        metrics = read_metrics(spark, root, run_id)
    return TrainResult(run, pred, metrics)


def score(matrix: DataFrame, run: Run) -> DataFrame:
    """Batch scoring: (trip_id, predicted_tip_amount decimal(13,2))."""
    scaled = conform(predict_scaled(run.model, matrix), SCALED_PREDICTION)
    return conform(inverse_scale(scaled, run.scaler), PREDICTION)
