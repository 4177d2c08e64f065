from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelwright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(8, shuffle_partitions=4, **{"spark.checkpoint.dir": str(folder)})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """One value of an expression over no table."""

    def evaluate(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return evaluate
