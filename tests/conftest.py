import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


def make_session(cores: str = "*", partitions: int = 8):
    from pyspark.sql import SparkSession
    ck = tempfile.mkdtemp(prefix="stray-test-ckpt-")
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("stray-tests")
             .config("spark.sql.shuffle.partitions", str(partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.checkpoint.dir", ck)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    s = make_session()
    yield s
    s.stop()
