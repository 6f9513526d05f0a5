import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ontime.session import ensure_checkpoint_dir, local_session
    s = local_session(4, shuffle_partitions=4, app="ontime-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    """Per-test local folder for test inputs (archives etc.)."""
    return str(tmp_path)
