from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from farecast.session import checkpoint_dir, local_session

    s = local_session(cores=8, shuffle_partitions=8, app="farecast-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # a fresh temporary shared folder, set only because none is configured
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from farecast.session import scratch_path

    return lambda label="t": scratch_path(spark, label)


_SAVED: dict = {}


def _once(name, spark, sf_dir):
    """Tables the tests share: written once a session (the queries themselves write theirs on every call)."""
    from farecast.plans import catalog

    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _SAVED:
        _SAVED[key] = getattr(catalog, name)(spark, sf_dir)
    return _SAVED[key]


def saved_bronze(spark, sf_dir):
    return _once("saved_bronze", spark, sf_dir)


def saved_silver(spark, sf_dir):
    return _once("saved_silver", spark, sf_dir)
