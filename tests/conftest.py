import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from quillstream.session import build_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # tests own their checkpoint folder; on a cluster the session's is used
    session = build_session(
        "local[8]",
        app_name="quillstream-tests",
        shuffle_partitions=8,
        checkpoint_dir=tempfile.mkdtemp(prefix="qs-test-ck-"),
    )
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="qs-test-")
