import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURES = os.path.join(os.path.dirname(__file__), "fixtures")
SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from corpusprep.session import apply_defaults

    ckpt = tempfile.mkdtemp(prefix="corpusprep-test-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("corpusprep-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    apply_defaults(s)
    yield s
    s.stop()
