"""Every registered query against its SQL on the smallest tables; queries without SQL must give rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(driver.queries()))
def test_query(spark, con, name):
    status, note = check_oracle.compare(spark, con, FOLDER, name)
    spark.catalog.clearCache()
    assert status in ("ok", "rows"), note


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["n_name", "n", "mean", "median", "sd", "deviation", "label"] and df.count() == 25
