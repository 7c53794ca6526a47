import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session("4")


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(key: str, value) -> None:
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
