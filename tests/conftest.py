import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="ledgerline-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from ledgerline.sources.tables import load_tables

    return load_tables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def duck():
    from oracle.compare import duck as make

    return make(SF_SMALL)
