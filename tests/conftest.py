import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import local_session, workspace  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="strata-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    """A fresh folder under the shared checkpoint root for one test."""
    return workspace(spark, request.node.name.replace("[", "-").replace("]", ""))


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
