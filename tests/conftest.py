import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("affinity-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests only: the session names no shared checkpoint folder, so use a private one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="affinity-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def toy(spark):
    """The 6-row toy ratings of the reference notebook (users A-C, items a-c)."""
    rows = [("A", "a", 2.0), ("A", "c", 2.0), ("B", "a", 1.0), ("B", "b", 2.0), ("C", "b", 3.0), ("C", "c", 5.0)]
    return spark.createDataFrame(rows, "user_id string, item_id string, rating double")
