import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from symgraph.session import local_session  # noqa: E402

DATA = os.environ.get("SYMGRAPH_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests", **{"spark.driver.memory": "4g"})


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    return DATA
