import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridcat.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="gridcat-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as a list of dicts, sorted for stable comparison."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    key = order or (lambda d: tuple(str(d[k]) for k in sorted(d)))
    return sorted(out, key=key)
