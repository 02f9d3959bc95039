from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskmart.session import build_session, clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("riskmart-tests", cores=4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a list of dicts ordered by the given columns."""
    def collect(df, *order):
        return [r.asDict(recursive=True) for r in df.orderBy(*order).collect()]

    return collect
