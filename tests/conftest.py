import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelkit.session import get_session
    s = get_session("local[*]", app="panelkit-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "6g"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="panelkit-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF001
