import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfline.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4, app_name="shelfline-tests",
                    checkpoint_dir=tempfile.mkdtemp(prefix="shelfline-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_lake():
    return tempfile.mkdtemp(prefix="shelfline-test-lake-")
