from __future__ import annotations

import os
import sys
import tempfile
from collections import Counter
from contextlib import contextmanager

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from gridwright.session import build_session

    warehouse = tempfile.mkdtemp(prefix="gridwright-wh-")
    session = build_session(
        "local[*]",
        app_name="gridwright-tests",
        shuffle_partitions=8,
        extra_conf={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "4g"},
    )
    yield session
    session.stop()


@contextmanager
def settings_of(spark, settings: dict):
    """Session settings inside the block, restored after it."""
    previous = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in previous.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def bag(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
