import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
TESTS = os.path.dirname(os.path.abspath(__file__))
if TESTS not in sys.path:
    sys.path.insert(0, TESTS)

from bazaar.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="bazaar-tests", shuffle_partitions=4)
    # tests own their checkpoint folder; on a cluster spark.checkpoint.dir names it
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bazaar-test-ckpt-"))
    yield session
    session.stop()
