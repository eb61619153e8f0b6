import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = os.environ.get("VAULTLINE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from vaultline.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="vaultline-tests")
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture()
def scratch(spark):
    from vaultline.session import scratch_path
    return scratch_path(spark, "test")
