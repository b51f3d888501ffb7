from __future__ import annotations

import pytest

from lettermill.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """DataFrame of (id, text) from a list."""

    def make(values):
        return spark.createDataFrame(list(enumerate(values)), "id long, text string")

    return make
