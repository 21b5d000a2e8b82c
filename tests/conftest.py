import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barlab.session import get_spark

    import tempfile

    s = get_spark(app="barlab-tests", master="local[4]", shuffle_partitions=8,
                  warehouse_dir=tempfile.mkdtemp(prefix="barlab-wh-"))
    yield s
    s.stop()


def approx_equal_frames(a, b, key, rel=1e-9, abs_=1e-9):
    """Row-by-row comparison of two pandas frames after sorting by ``key``."""
    import math

    a = a.sort_values(key).reset_index(drop=True)
    b = b.sort_values(key).reset_index(drop=True)
    assert list(a.columns) == list(b.columns)
    assert len(a) == len(b)
    for c in a.columns:
        for x, y in zip(a[c], b[c]):
            xn = x is None or (isinstance(x, float) and math.isnan(x))
            yn = y is None or (isinstance(y, float) and math.isnan(y))
            assert xn == yn, (c, x, y)
            if xn:
                continue
            if isinstance(x, float):
                assert math.isclose(x, y, rel_tol=rel, abs_tol=abs_), (c, x, y)
            else:
                assert x == y, (c, x, y)
