import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from salesabc.session import SESSION_DEFAULTS
    b = SparkSession.builder.master("local[4]").appName("salesabc-tests")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8")
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="salesabc-test-ckpt-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    from salesabc.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
