from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tests.session import local_session

    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def log_frame(spark):
    """Rows of a declared log from dicts; columns not named are NULL."""

    def make(spec, rows):
        return spark.createDataFrame(
            [tuple(row.get(c) for c in spec.columns) for row in rows], spec.schema
        )

    return make
