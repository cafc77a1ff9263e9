import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from depreco.session import get_spark

    s = get_spark("local[*]", shuffle_partitions=8)
    yield s


def rows(df, order=None):
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple(r[k] for k in order))
    return out
