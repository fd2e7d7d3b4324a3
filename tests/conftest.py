import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sifter.session import get_session

    scratch = tempfile.mkdtemp(prefix="sifter-tests-")
    s = get_session("local[*]", app_name="sifter-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                           "spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    SparkSession.getActiveSession() and s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
