import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


# Made on import: test modules build columns at their top level.
SESSION = (
    SparkSession.builder.master("local[4]")
    .appName("maillage-tests")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.driver.memory", "4g")
    .config("spark.ui.enabled", "false")
    .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def frame(spark):
    """Small frame from a DDL and rows."""

    def build(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return build


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, nulls first."""

    def collect(df, ordered=False):
        got = [tuple(r) for r in df.collect()]
        return got if ordered else sorted(got, key=lambda r: [(v is not None, v) for v in r])

    return collect
