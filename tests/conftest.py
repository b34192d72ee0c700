import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from backframe.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


def as_dicts(df, *keys):
    """Rows keyed by the named columns; a single key is not wrapped in a tuple."""
    out = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        out[key[0] if len(keys) == 1 else key] = row.asDict()
    return out
