import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TEST_SF = os.environ.get("QUARRY_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8, app="quarry-tests")
    yield s


@pytest.fixture(scope="session")
def registry():
    from quarry.plans.catalog import load_all
    return load_all()


@pytest.fixture(scope="session")
def duck():
    from quarry.plans.check import duck as make
    return make(TEST_SF)
