import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from payledger.config import FIXTURE_CONFIG  # noqa: E402
from payledger.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="payledger-tests")
    yield s


@pytest.fixture(scope="session")
def cfg():
    return FIXTURE_CONFIG


@pytest.fixture(scope="session")
def erp(spark):
    from payledger.sources.fixtures import erp_tables

    return erp_tables(spark, SF_SMALL)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)
