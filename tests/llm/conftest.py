from __future__ import annotations

import pathlib

import pytest

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside; input columns of the same name must not disturb them.
CLASHING = ("score", "kept", "key", "rank", "size", "unit", "print", "first", "length", "keep_id", "digest", "words", "features", "root",
            "node", "offset", "piece", "label", "quality", "owner", "copies")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHING)


@pytest.fixture(scope="session")
def sf():
    if not pathlib.Path(SF).exists():
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with clashing extra columns."""
    def build(rows):
        return spark.createDataFrame(
            [(r[0], r[1], r[2] if len(r) > 2 else "en", None, len(r[1] or ""), *["x"] * len(CLASHING)) for r in rows], SCHEMA)

    return build


LONG = "and the long text goes on " * 20_000
ODD = [(1, None, None), (2, ""), (3, "   \n\t"), (4, "12 34"), (5, "The same text, twice."), (6, "the same TEXT, twice."), (7, LONG), (8, LONG),
       (None, "a row without an id"), (9, "repeated row"), (9, "repeated row"), (10, "ÄÖÜ 中文 \U0001f600 é"),
       (11, "one"), (12, "licensed under the mit license mail a.b@c.org")]


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def nothing(make):
    return make([])


@pytest.fixture(scope="session")
def marks(spark):
    return spark.createDataFrame([(5, 1, 0), (6, None, 0), (7, 0, 1), (None, 1, 0), (5, 0, 0)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_marks(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def texts(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
