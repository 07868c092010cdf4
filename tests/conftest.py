import datetime as dt
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from checks.compare import session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def sf():
    return SMOKE_DIR


def at(text: str) -> dt.datetime:
    """Naive UTC datetime, as the session collects it."""
    return dt.datetime.fromisoformat(text)


def column(df, name):
    """Values of one column in row order of ``n``."""
    return [row[name] for row in df.orderBy("n").collect()]
