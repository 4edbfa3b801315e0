"""Shared pytest fixtures: one local session (UI off, 8 shuffle partitions) and temp folders."""

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tectonic.session import build_session
    warehouse = tempfile.mkdtemp(prefix="tectonic-wh-")
    s = build_session("local[*]", app_name="tectonic-tests", shuffle_partitions=8,
                      extra_conf={"spark.sql.warehouse.dir": warehouse,
                                  "spark.driver.extraJavaOptions":
                                      f"-Dderby.system.home={warehouse}"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tectonic-test-")
