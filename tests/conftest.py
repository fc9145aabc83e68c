import datetime as dt
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from motorlake.session import local_session  # noqa: E402

SMALL = os.environ.get("MOTORLAKE_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session("4", "motorlake-tests")


def ts(text: str) -> dt.datetime:
    """A UTC time as the local naive time Spark expects from Python."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=repr)
