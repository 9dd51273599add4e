"""Queries of the subpackage against their SQL twins."""

import pytest
from check_oracles import compare, connect
from llm_tables import SF_DIR

from claimward.llm import catalog


@pytest.mark.parametrize("name", [n for n in catalog.ORACLES if not n.startswith("op2_")])
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name, catalog.QUERIES[name], catalog.ORACLES[name]) == ""
