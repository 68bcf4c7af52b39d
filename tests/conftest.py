import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="quarry-tests", shuffle_partitions=4)
    checkpoint_dir(s)          # keeps the configured folder; only an unset one gets a fresh scratch folder
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
