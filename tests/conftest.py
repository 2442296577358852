import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = {k: f"/root/testdata/sf{k}" for k in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    from scoreline.session import get_spark

    s = get_spark(cores="*", shuffle_partitions=8)
    # tests own their checkpoint dir (a cluster names a shared one)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scoreline-test-"))
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF["0.001"]


def rows(df, order=None):
    """Collect as sorted list of dicts (tests only)."""
    out = [r.asDict() for r in df.collect()]
    key = order or sorted(out[0].keys()) if out else []
    return sorted(out, key=lambda r: tuple("" if r[k] is None else str(r[k]) for k in key))
