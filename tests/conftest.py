import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from orderflow.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="orderflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture(scope="session")
def con(sf_dir):
    from orderflow.plans.compare import duckdb_con
    return duckdb_con(sf_dir)


@pytest.fixture(scope="session")
def book(spark, sf_dir):
    from orderflow.plans.catalog import _tables
    return _tables(spark, sf_dir)
