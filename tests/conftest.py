import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeline.session import build_session

    s = build_session(master="local[*]", app="lakeline-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    """A fresh folder below the session's checkpoint root."""
    from lakeline.session import checkpoint_root

    root = checkpoint_root(spark)
    os.makedirs(root, exist_ok=True)
    return tempfile.mkdtemp(prefix="t-", dir=root)
