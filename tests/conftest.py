import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="brandflow-tests-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("brandflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", scratch)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
