"""Every registered query against its DuckDB SQL on the same tables (the
driver's correctness gate, run here at sf0.001); forest queries, which
have no SQL form, must at least run and keep their schema."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from farecast.plans.catalog import QUERIES
from tests.conftest import SMALL
from tests.oracle_compare import compare, duck

NO_SQL = {"train_metrics", "batch_predictions", "stream_predictions"}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_registry_is_complete():
    assert set(QUERIES) - set(oracle_sql()) == NO_SQL
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_SQL))
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SMALL).toPandas()
    want = con.sql(oracle_sql()[name]).df()
    assert compare(got, want) is None, compare(got, want)


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_query_without_sql_runs(spark, name):
    df = queries()[name](spark, SMALL)
    rows = df.collect()
    assert len(rows) > 0
    if name in ("batch_predictions", "stream_predictions"):
        assert df.columns == ["trip_id", "predicted_tip_amount"]
        assert len(rows) == spark.read.parquet(f"{SMALL}/events.parquet").count()


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["trip_id", "predicted_tip_amount"]
    assert df.count() > 0
