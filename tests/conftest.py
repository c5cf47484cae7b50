import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from candlewick.session import BROADCAST_CONF, REQUIRED_CONF, TUNING_CONF, configure

    scratch = tempfile.mkdtemp(prefix="candlewick-test-")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("candlewick-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", scratch + "/ckpt")
    )
    for k, v in {**REQUIRED_CONF, **BROADCAST_CONF, **TUNING_CONF}.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session
    session.stop()


SF_SMALL = "/root/testdata/sf0.001"
