import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from moodline.session import local_session  # noqa: E402

TESTDATA = os.environ.get("MOODLINE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "moodline-tests", **{"spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def medium_dir():
    return f"{TESTDATA}/sf0.01"
