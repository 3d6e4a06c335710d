"""The registered queries of the subpackage against their SQL."""

import pytest
from check_sql import compare, connect

from crawlspark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR, QUERIES, ORACLES) == ""
