import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelkit.session import local_session, shared_dir  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
