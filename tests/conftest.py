import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from obsframe.session import get_spark
    s = get_spark(app="obsframe-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *order):
    """Collect as a list of dicts, sorted by the given columns (NULLs first)."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda d: tuple((d[c] is not None, d[c]) for c in order))
    return out
