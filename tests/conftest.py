import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def change(key, value):
        changed.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def stations(spark):
    """Hand-written station rows for the edge cases."""
    schema = """stationcode string, name string, numbikesavailable int, numdocksavailable int,
        mechanical int, ebike int, is_installed string, is_renting string, arrondissement string"""
    return spark.createDataFrame([
        ("1", "both zero", 0, 0, 0, 0, "OUI", "OUI", "A"),
        ("2", "full", 7, 0, 3, 4, "OUI", "OUI", "A"),
        ("3", "empty", 0, 9, 0, 0, "OUI", "NON", "B"),
        ("4", "three docks", 5, 3, 5, 0, "NON", "OUI", "B"),
        ("5", "four docks", 5, 4, 2, 3, "OUI", None, None),
        ("6", "docks unknown", 2, None, 1, 1, None, "OUI", None),
        ("7", "bikes unknown", None, 4, None, 2, "OUI", "OUI", "B"),
        ("8", "all unknown", None, None, None, None, None, None, "C"),
    ], schema)


def by_code(df, column):
    return {r.stationcode: r[column] for r in df.collect()}


@pytest.fixture(name="by_code")
def _by_code():
    return by_code
