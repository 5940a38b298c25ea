import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from duelframe.session import build_session, ensure_checkpoint_dir
    s = build_session("local[*]", app="duelframe-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)  # a fresh local folder only when none is configured
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_sf001():
    from oracle_compare import duck
    return duck(SF001)
