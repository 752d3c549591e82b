from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from monthmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("tests", warehouse=str(tmp_path_factory.mktemp("warehouse")))


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, so that order does not matter."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in chosen.collect()), key=repr)

    return collect


@pytest.fixture
def listed():
    """Rows of a frame in their order."""
    return lambda df: [tuple(row) for row in df.collect()]
