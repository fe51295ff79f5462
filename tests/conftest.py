import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").appName("kempt-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kempt-ckpt-"))
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from kempt.session import shared_dir

    shared_dir(s)  # uses spark.checkpoint.dir when set; a private folder only in local mode
    yield s


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="kempt-test-")
