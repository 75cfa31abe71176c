import sys
import tempfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakestrata import RunContext, configure  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", work + "/warehouse")
        .config("spark.checkpoint.dir", work + "/shared")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield configure(s)
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def ctx():
    return RunContext(datetime(2025, 1, 10, 8, 0), "run-1", "spark", "lodging")


def at(day: int, run: str = "run") -> RunContext:
    return RunContext(datetime(2025, 1, day, 8, 0), f"{run}-{day}", "spark", "lodging")


def rows(df):
    """Order-free content of a frame."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
