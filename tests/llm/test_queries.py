"""Queries of the numbered operators against their SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from brindle.llm.queries import catalog  # noqa: E402
from compare import difference, duck  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.oracles))
def test_query_equals_sql(spark, name):
    assert difference(spark, duck(SF_DIR), catalog.plans[name], catalog.oracles[name], SF_DIR) is None


OTHERS = {"op5_exact_topk", "op11_prefix_trie", "op12_lexical_search", "op13_near_vectors"}


@pytest.mark.parametrize("name", sorted(set(catalog.plans) - OTHERS))
def test_query_gives_one_row_per_document(spark, name):
    rows = catalog.plans[name](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert rows.count() == rows.select("doc_id").distinct().count() == docs.count()
