import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fitweave.shared import finished  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def no_tables_left(spark):
    """Each module's own tables between steps go with it."""
    yield
    finished(spark)


@pytest.fixture
def rows_of():
    """Rows as a sorted list of tuples, nulls first."""

    def collect(df):
        found = [tuple(r) for r in df.collect()]
        return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
