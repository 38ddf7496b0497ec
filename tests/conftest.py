import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tradeloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, name="tests")
    yield session
    session.stop()


@pytest.fixture
def fresh(spark):
    """A new scratch path on every call."""
    from tradeloom.sources.scratch import fresh_path

    return lambda label="test": fresh_path(spark, label)
