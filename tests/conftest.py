import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def edges(spark):
    def make(*pairs):
        return spark.createDataFrame(list(pairs), "u BIGINT, v BIGINT")

    return make


@pytest.fixture
def lines(spark):
    def make(*texts):
        return spark.createDataFrame([(t,) for t in texts], "value STRING")

    return make


@pytest.fixture
def items(spark):
    def make(*values):
        return spark.createDataFrame([(v,) for v in values], "item BIGINT")

    return make


def scalar(df):
    """The one value of a one-row, one-column result."""
    (row,) = df.collect()
    (value,) = row
    return value


def pairs(df):
    return sorted(tuple(r) for r in df.collect())
