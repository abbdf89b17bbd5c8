"""The queries that SQL can express, against that SQL."""

import os

import pytest

from corvane.llm.queries import ORACLES, QUERIES
from tests.compare import differences, oracle_connection

SF_DIR = os.environ.get("CORVANE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLES[name]) is None
