import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cohort_effects.session import local_session

    ckpt = tempfile.mkdtemp(prefix="ce-tests-")
    s = local_session("local[4]", **{"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
