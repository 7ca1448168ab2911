import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session("local[*]", app="strata-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    yield s
    from strata.session import drop_scratch
    drop_scratch(s)
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="strata-test-")
