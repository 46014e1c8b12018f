import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from meridian.session import get_session
    s = get_session("local[*]", 4)
    yield s
    s.stop()


def edges_df(spark, pairs, weight=1):
    """Canonical edge table (u <= v) from (u, v) or (u, v, w) tuples."""
    rows = []
    for p in pairs:
        u, v = p[0], p[1]
        w = p[2] if len(p) > 2 else weight
        rows.append((min(u, v), max(u, v), w))
    return spark.createDataFrame(rows, "u long, v long, weight long")
