"""Queries of the training-data operators against their SQL counterparts."""

import pytest
from oracle import compare, connect

from tidemark.llm.queries import llm_oracles, llm_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, llm_queries()[name], llm_oracles()[name]) == ""
