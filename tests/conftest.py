import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from eventlake.session import build_session

    session = build_session(
        master="local[4]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="4g",
    )
    yield session
    session.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
