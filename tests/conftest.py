from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Values of one column expression over rows given as a list."""

    def run(rows, schema, expression):
        df = spark.createDataFrame([row if isinstance(row, tuple) else (row,) for row in rows], schema)
        return [r[0] for r in df.select(expression.alias("v")).collect()]

    return run


@pytest.fixture
def plan(capsys):
    """The physical plan of a frame as text."""

    def text(df) -> str:
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text
