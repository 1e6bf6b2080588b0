import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from flowtally.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", partitions=4)


@pytest.fixture
def frame(spark):
    """``frame("a, b", rows)``: a DataFrame of string columns."""

    def make(columns, rows):
        names = [name.strip() for name in columns.split(",")]
        return spark.createDataFrame([tuple(row) for row in rows], ", ".join(f"{name} string" for name in names))

    return make


@pytest.fixture
def column(spark):
    """``column(function, values)``: the values of a column expression over strings."""

    def evaluate(function, values):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, x string").coalesce(1)
        from pyspark.sql import functions as F

        return [row[0] for row in rows.sort("i").select(function(F.col("x")).alias("y")).collect()]

    return evaluate
