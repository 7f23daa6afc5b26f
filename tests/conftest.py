import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sessionlab.config import build_session
    s = build_session("local[4]", app="sessionlab-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "6g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sessionlab-test-ckpt-"))
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"
