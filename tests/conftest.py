from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from silsila.plans.session import local_session

    session = local_session("tests", "8", 4)
    yield session
    session.stop()


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
