import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from emberlog.session import build_session
    s = build_session("local[4]", app="emberlog-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="emberlog-test-"),
                             "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
