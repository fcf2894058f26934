"""Sampling, top-n, splits (N1-N4) and scaling (A3, L1, L5) against brute force."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from farecast.functions.hashing import HASH_RANGE, SAMPLE, SPLIT, TOP, hash_order
from farecast.operators.features import model_matrix
from farecast.operators import sampling
from farecast.operators.sampling import Cut, cuts, sample_fraction, split_exact, split_hashed, take_first
from farecast.operators.scaling import Scaler, fit_scaler, inverse_scale, scale
from tests.conftest import MEDIUM, SMALL, saved_silver


@pytest.fixture(scope="module")
def matrix(spark):
    return model_matrix(saved_silver(spark, SMALL))


def _brute_order(df, salt=TOP):
    return [r["trip_id"] for r in df.select("trip_id", hash_order("trip_id", salt).alias("h")).orderBy("h", "trip_id").collect()]


@pytest.mark.parametrize("n", [1, 7, 100, 333, 999, 1000, 5000])
def test_take_first_equals_sorted_prefix(spark, matrix, n):
    order = _brute_order(matrix)
    got = sorted(r["trip_id"] for r in take_first(matrix, n).select("trip_id").collect())
    assert got == sorted(order[:n])


def test_take_first_rows_are_whole(spark, matrix):
    got = take_first(matrix, 10)
    assert got.columns == matrix.columns
    assert got.join(matrix, "trip_id", "left_anti").count() == 0


def test_sample_fraction(spark, matrix):
    assert sample_fraction(matrix, 1.0).count() == matrix.count()
    small = sample_fraction(matrix, 0.2)
    big = sample_fraction(matrix, 0.5)
    assert small.join(big, "trip_id", "left_anti").count() == 0  # nested
    assert 0.1 < small.count() / matrix.count() < 0.3


@pytest.mark.parametrize("fraction", [0.7, 0.5, 0.0, 1.0])
def test_split_exact_positional(spark, matrix, fraction):
    order = _brute_order(matrix, SPLIT)
    k = int(fraction * len(order))
    got = dict(split_exact(matrix, fraction).select("trip_id", "data_type").collect())
    assert {t for t, d in got.items() if d == "train"} == set(order[:k])
    assert {t for t, d in got.items() if d == "test"} == set(order[k:])


def test_split_exact_with_validation(spark, matrix):
    order = _brute_order(matrix, SPLIT)
    n = len(order)
    got = dict(split_exact(matrix, 0.6, 0.2).select("trip_id", "data_type").collect())
    k1, k2 = int(0.6 * n), int(0.2 * n)
    assert [got[t] for t in order] == ["train"] * k1 + ["validation"] * k2 + ["test"] * (n - k1 - k2)


def test_split_hashed_share(spark):
    m = model_matrix(saved_silver(spark, MEDIUM))
    tagged = split_hashed(m, 0.7)
    share = tagged.where(F.col("data_type") == "train").count() / tagged.count()
    assert abs(share - 0.7) < 0.03
    t = math.ceil(0.7 * HASH_RANGE)
    assert tagged.where((F.col("data_type") == "train") != (hash_order("trip_id", SPLIT) < t)).count() == 0


def test_scaler_round_trip_is_identity(spark, matrix):
    sc = fit_scaler(matrix, "tip_amount")
    back = inverse_scale(scale(matrix, sc, "tip_amount", "z"), sc, "z", "tip_back")
    assert back.where(F.col("tip_back") != F.col("tip_amount")).count() == 0


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "tip_amount double")
    sc = fit_scaler(df)
    assert sc.mean == pytest.approx(2.5) and sc.std == pytest.approx(math.sqrt(1.25))


def test_constant_target_uses_unit_scale(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (2.0,)], "tip_amount double")
    sc = fit_scaler(df)
    assert sc == Scaler(2.0, 0.0) and sc.scale == 1.0
    assert [r["tip_amount"] for r in scale(df, sc).collect()] == [0.0, 0.0, 0.0]


def test_fit_on_train_only(spark):
    df = spark.createDataFrame([(1.0, "train"), (3.0, "train"), (100.0, "test")], "tip_amount double, data_type string")
    assert fit_scaler(df, fit_on="train").mean == pytest.approx(2.0)
    assert fit_scaler(df, fit_on="all").mean == pytest.approx(104.0 / 3)


@pytest.mark.parametrize("few,level", [(2048, 15), (8, 15), (1, 3), (0, 7)])
def test_cuts_find_the_row_at_every_position(spark, matrix, monkeypatch, few, level):
    """However many levels the selection takes, the cut is the row that a full sort has there."""
    monkeypatch.setattr(sampling, "FEW", few)
    monkeypatch.setattr(sampling, "LEVEL_BITS", level)
    rows = matrix.select(hash_order("trip_id", SPLIT).alias("h"), "trip_id").orderBy("h", "trip_id").collect()
    positions = [1, 2, 499, len(rows) - 1]
    assert cuts(matrix, positions) == [Cut(rows[n - 1]["h"], rows[n - 1]["trip_id"]) for n in positions]
    assert cuts(matrix, [0, len(rows), len(rows) + 5]) == [Cut(-1), Cut(None), Cut(None)]


def test_repeated_keys_stay_on_one_side(spark):
    df = spark.createDataFrame([(i // 4, i) for i in range(400)] + [(None, 1000), (None, 1001)], "trip_id long, x long")
    for n in (1, 2, 101, 399):
        got = take_first(df, n)
        assert n <= got.count() < n + 4
        assert got.groupBy("trip_id").count().where("count < 4 and trip_id is not null").count() == 0


def test_empty_table_splits_to_nothing(spark):
    none = spark.createDataFrame([], "trip_id long")
    assert split_exact(none).count() == take_first(none, 5).count() == 0


def test_null_keys_are_sampled_like_any_other(spark):
    df = spark.createDataFrame([(None, 0)] + [(i, i) for i in range(1, 40)], "trip_id long, x long")
    assert take_first(df, 100).count() == 40 and take_first(df, 5).count() == 5
    assert split_exact(df, 0.5).where("data_type = 'train'").count() == 20
    for fraction in (0.2, 0.5, 1.0):
        kept = sample_fraction(df, fraction).where(F.col("trip_id").isNull()).count()
        h = df.where(F.col("trip_id").isNull()).select(hash_order("trip_id", SAMPLE).alias("h")).first()["h"]
        assert kept == (h < math.ceil(fraction * HASH_RANGE))


@pytest.mark.parametrize("seed", range(10))
def test_every_seed_keeps_its_fraction_and_still_splits(spark, seed):
    ids = spark.range(40_000).select(F.col("id").cast("int").alias("trip_id"))  # int keys, too
    kept = sample_fraction(ids, 0.25, seed=seed)
    n = kept.count()
    assert abs(n / 40_000 - 0.25) < 0.01
    train = split_hashed(kept, 0.7).where("data_type = 'train'").count()
    assert abs(train / n - 0.7) < 0.03


def test_seeded_samples_differ_and_repeat(spark, matrix):
    a = sample_fraction(matrix, 0.3, seed=12345).select("trip_id")
    b = sample_fraction(matrix, 0.3, seed=12345).select("trip_id")
    c = sample_fraction(matrix, 0.3, seed=7).select("trip_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.exceptAll(c).count() > 0
    assert 0.2 < a.count() / matrix.count() < 0.4
