"""The registered text queries against their SQL."""

import os

import pytest

from checks.compare import connect, differences
from retailprep.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) == []
