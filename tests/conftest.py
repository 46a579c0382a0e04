import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chainmetrics.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when omitted)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
