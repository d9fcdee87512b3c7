import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from costmart.session import build_session  # noqa: E402

SF_SMALL = os.environ.get("COSTMART_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, app="costmart-tests",
                      # tests that look at the executions they start need them kept through the whole suite
                      extra={"spark.driver.memory": "4g", "spark.sql.ui.retainedExecutions": "100000"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
