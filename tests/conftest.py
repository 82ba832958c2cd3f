import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"
ORACLE_DIR = os.environ.get("TILLFLOW_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tillflow.session import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[4]")
        .appName("tillflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # A zone with a daylight-saving gap: results must not depend on it.
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch(spark):
    from tillflow.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)

    return make
