import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import build_session
    scratch = tempfile.mkdtemp(prefix="cartwheel-tests-")
    s = build_session("local[4]", 4, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
    })
    yield s


@pytest.fixture(scope="session")
def scratch_dir():
    return tempfile.mkdtemp(prefix="cartwheel-out-")
