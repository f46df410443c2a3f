import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tontine.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]").appName("tontine-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "6g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def raw_small(spark):
    from tontine.sources.fixtures import load_inputs
    return load_inputs(spark, SF_SMALL)


@pytest.fixture(scope="session")
def val_small(raw_small):
    from tontine.plans.pipeline import Valuation
    return Valuation(raw_small)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tontine-test-")
