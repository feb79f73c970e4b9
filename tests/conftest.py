import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from meterstar.session import get_session

    s = get_session("local[4]", app="meterstar-tests", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false",
                           # the library's scratch folder is named by whoever starts the session
                           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="meterstar-shared-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # a fresh scratch folder per test (never shared, never cleaned by rm)
    return tempfile.mkdtemp(prefix="meterstar-test-")
