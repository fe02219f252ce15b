"""Every registered query against its oracle on the smallest tables."""

from __future__ import annotations

import pathlib

import pytest

from silsila.plans.catalog import ORACLES, QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not pathlib.Path(SF).exists():
        pytest.skip("no test tables")
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert name in ORACLES
    ok, note = compare(QUERIES[name](spark, SF), duck, ORACLES[name])
    assert ok, note
