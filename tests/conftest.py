import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from kerbside.session import prepare
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", "8")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return prepare(session)


@pytest.fixture
def folder(spark):
    from kerbside.session import working_folder
    return working_folder(spark, "test")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
