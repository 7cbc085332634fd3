from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from compare import connect  # noqa: E402

from starlift.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("starlift-tests", spark__sql__warehouse__dir=f"/tmp/starlift-tests-{os.getpid()}")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def tables(sf_dir):
    return connect(sf_dir)


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows(frame):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def final_plan(frame) -> str:
    """The plan AQE ended with, after the frame has run."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
