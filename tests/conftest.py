import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "8g")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder, as the cluster would via spark.checkpoint.dir
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="txgraph-test-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="txgraph-test-", dir="/tmp")
