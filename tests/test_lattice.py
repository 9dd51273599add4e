"""Stored grouping sets against the claims."""

import itertools

import pytest

from claimward.catalog import intake
from claimward.operators import lattice, metrics
from claimward.plans import refresh, reports

ADDED = list(lattice.FROM_SUMS)
COUNTED = list(lattice.FROM_KEYS)
MIXED = ["total_claims", "avg_length_of_stay", "fraud_rate", "total_beneficiaries"]
SLICER = {"region": ["South", "West"], "gender": ["Female"], "year_num": [1995, 1996]}

#: Metrics, group columns, filters and the set that holds the request.
REQUESTS = [
    (ADDED + COUNTED, [], None, "path"),
    (ADDED + COUNTED, ["region", "gender"], None, "path"),
    (ADDED + COUNTED, ["year_num", "month_num"], {"claim_type": ["Inpatient"]}, "type_month"),
    (MIXED, ["year_month", "month_name"], SLICER, "path_month"),
    (MIXED, ["age_group"], {"month_name": ["May", "June"]}, "path_month"),
    (MIXED, [], {"region": ["nowhere"]}, "path"),
    (ADDED, ["state_name", "claim_type"], {"month_num": [1, 2, 3]}, "state_month"),
    (ADDED, ["provider_id", "fraud_label"], {"claim_type": ["Outpatient"]}, "provider"),
    (MIXED, ["provider_id"], None, None),
    (MIXED, ["state_name"], None, None),
    (ADDED, ["region"], {"admission_duration_days": [0, 1, 2]}, None),
]


@pytest.fixture(scope="module")
def published(spark):
    return refresh.published_model(spark, intake.refreshed_root(spark, "/root/testdata/sf0.001"))


def rows(df):
    def value(x):
        return round(x, 9) if isinstance(x, float) else x

    return sorted((tuple((k, value(v)) for k, v in sorted(r.asDict().items())) for r in df.collect()), key=str)


@pytest.mark.parametrize("names,by,filters,chosen", REQUESTS)
def test_a_request_gets_the_rows_of_the_claims(published, names, by, filters, chosen):
    assert lattice.smallest(published, names, by, filters) == chosen
    found = lattice.answer(published, names, by, filters)
    direct = metrics.metrics(published, names, by, filters)
    assert found.dtypes == direct.dtypes
    assert rows(found) == rows(direct)
    read = {part for f in found.inputFiles() for part in f.split("/") if part.startswith(("agg_", "fact_"))}
    if chosen:
        assert read <= {lattice.sums_table(chosen), lattice.keys_table(chosen)}
    else:
        assert "fact_claims" in read


def test_coarser_sets_have_fewer_rows_and_the_fewest_win(published):
    size = {name: published.rollup_rows[lattice.sums_table(name)] for name in lattice.LATTICE}
    assert size["path"] < size["path_month"] and size["type_month"] < size["path_month"]
    columns = sorted({c for wanted in lattice.LATTICE.values() for c in wanted.columns})
    for by in itertools.combinations(columns, 2):
        holding = [n for n, wanted in lattice.LATTICE.items() if set(by) <= set(wanted.columns)]
        chosen = lattice.smallest(published, ["total_claims"], list(by))
        assert size.get(chosen) == min((size[n] for n in holding), default=None)


def test_report_pages_read_no_claims(published):
    assert not [f for f in reports.drill(published).inputFiles() if "fact_claims" in f]
    assert not [f for f in reports.sliced(published, SLICER).inputFiles() if "fact_claims" in f]
    for label in metrics.SWITCH:
        found = lattice.by_name(published, label, ["region"], SLICER)
        assert rows(found) == rows(metrics.by_name(published, label, ["region"], SLICER))


def test_a_model_without_stored_sets_reads_the_claims(published, star_model):
    bare = star_model([("C1", 1, 1, "Inpatient", None, 10, 2, 3)]) if callable(star_model) else star_model
    assert lattice.smallest(bare, ["total_claims"], []) is None
    assert lattice.answer(bare, ["total_claims"]).collect()[0].total_claims == bare.fact.count()


def test_unknown_metrics_are_refused(published):
    with pytest.raises(KeyError, match="unknown metrics"):
        lattice.answer(published, ["no_such_metric"])
