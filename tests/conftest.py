import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from switchboard.session import apply_defaults, shared_dir

    s = (SparkSession.builder.master("local[*]")
         .appName("switchboard-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_defaults(s)
    # use the configured shared folder; only when none is configured does
    # shared_dir() create a private one for the test run
    shared_dir(s)
    yield s
    s.stop()
