import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from lakeops.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda r: [(x is not None, str(x)) for x in r])

    return collect
