import shutil
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests"), str(ROOT / "tests" / "llm")]

from coldshelf.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="coldshelf-tests-")
    session = local_session("4", shuffle_partitions=2, shared=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    shutil.rmtree(shared, ignore_errors=True)
