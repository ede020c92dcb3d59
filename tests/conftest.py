import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch():
    """A fresh scratch folder per test run (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    from modelsmith.session import local_session

    session = local_session(
        cpus="*",
        shuffle_partitions=8,
        warehouse=os.path.join(scratch, "warehouse"),
        checkpoint_dir=os.path.join(scratch, "checkpoints"),
        app_name="modelsmith-tests",
    )
    yield session
    session.stop()


def rows(df, *cols):
    """Rows as sorted tuples (order-insensitive comparison)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
