"""Every query of the subpackage on the smallest tables: SQL where there is some."""

from __future__ import annotations

import os

import pytest

from tests.compare import connect, difference
from windrow.llm import queries as llm

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("key", sorted(llm.ORACLE))
def test_query_matches_sql(spark, key):
    assert difference(llm.QUERIES[key](spark, SF_DIR), connect(SF_DIR), llm.ORACLE[key]) is None


# One row per piece, not per document.
PIECES = {"op12_packing"}


@pytest.mark.parametrize("key", sorted(set(llm.QUERIES) - set(llm.ORACLE) - PIECES))
def test_one_row_per_document(spark, key):
    out = llm.QUERIES[key](spark, SF_DIR).toPandas()
    ids = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").toPandas()
    assert sorted(out.doc_id) == sorted(ids.doc_id)
    assert not out.drop(columns="text", errors="ignore").isnull().any().any()


def test_names():
    import __spark_entry__ as contract

    names = contract.queries()
    assert all(sum(k.startswith(f"op{n}_") for k in names) == 1 for n in range(1, 14))
    assert "pipeline" in names
