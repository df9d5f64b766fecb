import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        # Plans name their inputs in full, however long the folder's name is.
        .config("spark.sql.maxMetadataStringLength", "4000")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="anchorline-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def staging(spark):
    from anchorline.sources.staging import Staging

    return Staging(spark)
