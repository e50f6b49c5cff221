import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app="tidewater-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive comparisons)."""
    if cols:
        df = df.select(*cols)
    key = lambda t: tuple((x is None, 0 if x is None else x) for x in t)  # noqa: E731  nulls last
    return sorted((tuple(r) for r in df.collect()), key=key)
