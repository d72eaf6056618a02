import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketpulse.session import checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="marketpulse-tests")
    checkpoint_dir(s)  # the configured spark.checkpoint.dir, or a scratch folder when it is unset
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="mp-test-")
