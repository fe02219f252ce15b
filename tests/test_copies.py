"""Queries over copies of the small tables with shifted keys: every other value, names too, then comes several times."""

from __future__ import annotations

import pathlib
import shutil

import duckdb
import pytest

from silsila.plans.catalog import ORACLES, QUERIES
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
KEYS = {"supplier": ("suppkey",), "part": ("partkey",), "orders": ("orderkey", "custkey"), "lineitem": ("orderkey", "partkey", "suppkey")}
COPIES, SHIFT = 3, 1_000_000


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    if not pathlib.Path(SF).exists():
        pytest.skip("no test tables")
    out = tmp_path_factory.mktemp("copies")
    for name in ("nation", "region"):
        shutil.copy(f"{SF}/{name}.parquet", out / f"{name}.parquet")
    con = duckdb.connect()
    for name, keys in KEYS.items():
        shifted = ", ".join(f"({name[0]}_{k} + i * {SHIFT})::BIGINT AS {name[0]}_{k}" for k in keys)
        con.execute(f"COPY (SELECT t.* REPLACE ({shifted}) FROM '{SF}/{name}.parquet' t, range({COPIES}) r(i)) TO '{out}/{name}.parquet' (FORMAT parquet)")
    for name in (*KEYS, "nation", "region"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{out}/{name}.parquet'")
    return str(out), con


@pytest.mark.parametrize("name", ["list_context", "source_card_resolve", "specific_context", "explicit_relatives"])
def test_query_over_copies(spark, copies, name):
    folder, con = copies
    ok, note = compare(QUERIES[name](spark, folder), con, ORACLES[name])
    assert ok, note
