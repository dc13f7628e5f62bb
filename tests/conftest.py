import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldstat.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="fieldstat-tests")
    yield s


@pytest.fixture
def scratch(tmp_path):
    """Per-test scratch folder (tests only; library code uses the shared
    checkpoint folder of the session)."""
    return str(tmp_path)
