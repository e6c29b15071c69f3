import os
import sys
from pathlib import Path

import pytest

# The reference computations of the tests need no threads inside the linear algebra library.
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

import __spark_entry__  # noqa: E402,F401
from seriesmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", cores="8", shuffle_partitions=8)
    yield s
    s.stop()
