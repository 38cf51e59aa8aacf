from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("railcadence-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "Europe/Paris")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate an expression over one row of named values."""
    def run(expr, schema="v string", *values):
        return spark.createDataFrame([values or (None,)], schema).select(expr.alias("x")).first()["x"]

    return run


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.fixture(scope="session")
def rows():
    return sorted_rows


@pytest.fixture(scope="session")
def stops(spark):
    return spark.createDataFrame(
        [(0, 100, "gare_a", "gare_a"), (1, 200, "gare_b", "gare_b"), (2, 300, "gare_c", "gare_c")],
        "stop_seq int, stop_id int, stop_name string, stop_key string",
    )
