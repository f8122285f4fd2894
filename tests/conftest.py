import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airmill.session import ensure_checkpoint_dir, get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
