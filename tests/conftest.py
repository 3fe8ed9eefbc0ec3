import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerwell.fixtures.testdata import CONFIG, TestData  # noqa: E402
from ledgerwell.plans.warehouse import Warehouse  # noqa: E402
from ledgerwell.session import local_session  # noqa: E402

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests", shuffle=4, memory="4g")


@pytest.fixture(scope="session")
def cfg():
    return CONFIG


@pytest.fixture(scope="session")
def warehouse(spark, cfg):
    return Warehouse(spark, TestData(spark, ROOT).inputs(), cfg)


@pytest.fixture(scope="module")
def resolved(warehouse):
    df = warehouse.int_transactions().cache()
    yield df
    df.unpersist()
