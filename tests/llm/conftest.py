from __future__ import annotations

import pytest

from millrace.llm.common import ready

EDGES = [
    (None, None), (None, ""), (-1, ""), (-1, ""), (-2, None), (-3, "!!! ... ---"), (-4, "x"), (-4, "x"), (-5, "é"), (-6, "word " * 30_000),
    (-7, "7" * 50_000), (-8, "a@b" + ".c" * 20_000), (-9, "\n\t   "), (-10, "\U0001f600 ok 　 ok"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Supplied documents with rows for every edge, and columns whose names operators use inside."""
    ready(spark)
    own = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120).select("doc_id", "text", "lang", "source", "n_chars")
    edges = spark.createDataFrame([(i, t, None, None, None) for i, t in EDGES], own.schema)
    both = own.unionByName(edges)
    return both.selectExpr("*", "1 AS key", "2 AS h", "3 AS root", "4 AS text_key", "5 AS row", "6 AS base", "7 AS added", "8 AS content", "9 AS score").cache()


@pytest.fixture(scope="session")
def texts(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]

