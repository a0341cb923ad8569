import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("basketry-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def toy_lines(spark):
    """Five baskets over three items."""
    baskets = {"1": "abc", "2": "ab", "3": "ac", "4": "bc", "5": "abc"}
    rows = [(basket, item) for basket, items in baskets.items() for item in items]
    return spark.createDataFrame(rows, "basket_id string, item string")
