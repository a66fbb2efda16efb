import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakestar.session import local_session

    s = local_session(4, shuffle_partitions=4, app="lakestar-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def gold(spark, sf_small):
    from lakestar.plans.warehouse import testdata_warehouse

    return testdata_warehouse(spark, sf_small)


def col_values(df, col="v"):
    return [r[col] for r in df.collect()]
