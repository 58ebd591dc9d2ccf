from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickloom.catalog.common import events_panel  # noqa: E402
from tickloom.session import local_session  # noqa: E402
from tickloom.sources.generate import generate_panel  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def hot_events(spark):
    """events in which one user owns a third of the rows, and one hour another third."""
    df = events_panel(spark, "/root/testdata/sf0.01")
    third = F.col("event_id") % 3
    return df.withColumns(
        {
            "symbol_id": F.when(third == 0, F.lit(0)).otherwise(F.col("symbol_id")),
            "time_id": F.when(third == 1, F.lit(5)).otherwise(F.col("time_id")),
        }
    ).persist()


@pytest.fixture(scope="session")
def panel(spark):
    return generate_panel(spark, 20, 10, 15, seed=0, features=4).persist()


@pytest.fixture(scope="session")
def small(spark):
    return generate_panel(spark, 5, 5, 5, seed=1, features=4).persist()
