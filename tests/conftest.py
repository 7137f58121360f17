import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import configure, setting  # noqa: E402

DATA = "/root/testdata"
GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("millrace-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Run with every side treated as too large to broadcast."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        yield spark


def rows(df):
    """Rows as a sorted list of plain tuples, in column order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
