import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakevault.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[*]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    # a fresh folder per test; never reused, never cleared
    return tempfile.mkdtemp(prefix="lakevault-test-", dir="/tmp")


def plan_text(df) -> str:
    """The formatted physical plan (not truncated)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()
