"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest
from oracle import compare, connect

from tidemark.workload import all_oracles, all_queries

FOLDER = os.environ.get("TIDEMARK_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    verdict = compare(spark, con, FOLDER, all_queries()[name], all_oracles()[name])
    if verdict == "no rows":  # the smallest tables hold no such case; the next ones must
        larger = FOLDER.replace("sf0.001", "sf0.01")
        verdict = compare(spark, connect(larger), larger, all_queries()[name], all_oracles()[name])
    assert verdict == ""
