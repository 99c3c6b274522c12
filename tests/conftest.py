import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidewell.session import build_session

    s = build_session("local[*]", app="tidewell-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewell-test-ckpt-"))
    yield s
    s.stop()
