import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerprofile.session import LOCAL_CONF, checkpoint_dir  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="ledgerprofile-tests-")
    builder = (SparkSession.builder.master("local[*]")
               .appName("ledgerprofile-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse")))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return f"{TESTDATA}/sf0.001"


def months_frame(spark, rows):
    """Taxpayer-month frame (hy_dm, nsrsbh, ny, lr, jxje, xxje) from (nsrsbh, ny, xxje[, hy_dm])."""
    data = []
    for r in rows:
        nsrsbh, ny, xx = r[:3]
        hy = r[3] if len(r) > 3 else "H1"
        data.append((hy, nsrsbh, int(ny), None if xx is None else float(xx) / 2,
                     None if xx is None else float(xx) / 2, None if xx is None else float(xx)))
    return spark.createDataFrame(
        data, "hy_dm string, nsrsbh string, ny int, lr double, jxje double, xxje double")
