import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stockroom.session import build_session
    d = tempfile.mkdtemp(prefix="tests-")
    s = build_session("local[4]", app="tests", **{"spark.checkpoint.dir": os.path.join(d, "ckpt")})
    s.sparkContext.setCheckpointDir(os.path.join(d, "ckpt"))
    yield s
    s.stop()
