import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session, require_checkpoint_dir, ship_package

    s = build_session(master="local[*]", shuffle_partitions=8)
    ship_package(s)
    require_checkpoint_dir(s, tempfile.mkdtemp(prefix="tidewater-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidewater-test-")
