"""Registered queries against their SQL twins on the smallest tables.

``check_oracles.py`` runs all of them; the sample here touches every module.
"""

import pytest
from check_oracles import compare, connect
from conftest import SF_DIR

import __spark_entry__ as catalog
from claimward.catalog import registry

SAMPLE = [
    "exe_alerts",
    "fin_outliers",
    "rsk_watchlist",
    "rsk_top_profile",
    "pop_high_utilizers",
    "pop_utilizer_profile",
    "ops_los",
    "geo_quadrant",
    "gld_fact",
    "gld_agg_disease_text",
    "prf_columns",
    "slv_claims_ip",
    "val_gld_kpi",
    "val_findings",
    "pub_geo_state",
    "met_briefing",
    "dec_disease_counts",
    "vis_topn_sets",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_of_the_library_has_its_twin():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(catalog.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    query, sql = catalog.queries()[name], catalog.oracle_sql()[name]
    assert compare(spark, duck, SF_DIR, name, query, sql) == ""


def test_entry_is_the_investigation_queue(spark):
    df = catalog.entry(spark)
    assert "investigation_priority" in df.columns and df.count() > 0
