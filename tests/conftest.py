import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pricetide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def set_option(name, value):
        changed.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_option
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
