import pytest
from test_intake import BENE, IP, OP, files, lines  # noqa: F401

from claimward.config import Expectations
from claimward.operators import gold
from claimward.operators.tally import ValidationError
from claimward.plans import executive, refresh, risk
from claimward.sources import tables


def sources(files, **more):  # noqa: F811
    providers = [{"Provider": f"P{i}", "PotentialFraud": "Yes" if i == 1 else "No"} for i in (1, 2)]
    people = [BENE | {"BeneID": f"B{i}", "State": s} for i, s in ((1, "1"), (2, "40"), (3, "54"))]
    ip = [IP | {"ClaimID": "C1"}, IP | {"ClaimID": "C2", "BeneID": "B2", "Provider": "P2"}]
    op = [
        OP | {"ClaimID": "C3", "BeneID": "B3"},
        OP | {"ClaimID": "C4", "Provider": "P?"},
        OP | {"ClaimID": "C5", "BeneID": "B?"},
        OP | {"ClaimID": "C6", "ClaimStartDt": "2009-13-40"},
    ]
    return files(
        provider=lines("provider", *providers),
        inpatient=lines("inpatient", *ip),
        outpatient=lines("outpatient", *op),
        beneficiary=lines("beneficiary", *people),
        **more,
    )


def test_refresh_publishes_a_consistent_star(spark, files, tmp_path):  # noqa: F811
    root = str(tmp_path / "warehouse")
    expected = Expectations(raw={"provider": 2, "outpatient": 4}, silver={"stg_claims": 6}, gold={"fact_claims": 4})
    result = refresh.refresh_from_files(spark, sources(files), root, expected)
    star = tables.read_published(spark, root, "gold")
    assert set(star) == {
        "dim_provider", "dim_beneficiary", "dim_date", "dim_geography", "fact_claims",
        "agg_provider_summary", "agg_state_monthly", "agg_chronic_disease",
    }
    assert {r.claim_id for r in star["fact_claims"].collect()} == {"C1", "C2", "C3", "C6"}
    counts = {r.table_name: r.rows_written for r in result.counts.collect()}
    assert counts["stg_claims"] == 6 and counts["dim_geography"] == 52
    states = {(r.state_code, r.region, r.total_claims) for r in star["agg_state_monthly"].collect()}
    assert states == {(1, "South", 1), (gold.UNMAPPED_STATE, "Unmapped", 1), (54, "Unknown", 1)}
    findings = {r.check_name: r.issue_count for r in result.findings.collect()}
    assert findings["stg_claims.provider_id: not in stg_provider"] == 1
    assert findings["fact_claims.claim_start_date_key: null"] == 1
    assert findings["agg_provider_summary: amount differ from fact"] == 0
    rollup = {r.provider_id: r for r in star["agg_provider_summary"].collect()}
    assert rollup["P1"].total_claims == 3 and rollup["P2"].same_day_discharge_claims == 0

    model = refresh.published_model(spark, root)
    assert executive.portfolio(model).collect()[0].total_claims == 4
    assert risk.watchlist(model).count() == 2


def test_unmatched_claims_are_counted(spark, files):  # noqa: F811
    from claimward.operators import silver
    from claimward.sources.text import read_all, strip_quotes

    raw = read_all(spark, sources(files), "b")
    stg = silver.silver({**raw, "beneficiary": strip_quotes(raw["beneficiary"])})
    row = gold.unmatched_claims(stg["stg_claims"], stg["stg_provider"], stg["stg_beneficiary"]).collect()[0]
    assert (row.no_provider, row.no_beneficiary, row.dropped_claims) == (1, 1, 2)


def test_a_failed_gate_leaves_the_previous_batch_current(spark, files, tmp_path):  # noqa: F811
    root = str(tmp_path / "warehouse")
    refresh.refresh_from_files(spark, sources(files), root)
    before = {r.table_name: r.path for r in tables.current(spark, root).collect()}
    from claimward.sources.text import read_all

    broken = sources(files) | {}
    raw = read_all(spark, broken, "20990101_000000")
    raw["inpatient"] = raw["inpatient"].unionByName(raw["inpatient"])  # duplicate keys
    with pytest.raises(ValidationError):
        refresh.refresh(spark, raw, root, "20990101_000000")
    assert {r.table_name: r.path for r in tables.current(spark, root).collect()} == before
    with pytest.raises(ValidationError, match="row count"):
        refresh.refresh_from_files(spark, broken, root, Expectations(raw={"provider": 99}))


def test_second_refresh_replaces_the_first(spark, files, tmp_path):  # noqa: F811
    root = str(tmp_path / "warehouse")
    from claimward.sources.text import read_all

    for batch, n in (("20240101_000000", 2), ("20240102_000000", 1)):
        raw = read_all(spark, sources(files), batch)
        raw["inpatient"] = raw["inpatient"].limit(n)
        refresh.refresh(spark, raw, root, batch)
    now = {(r.layer, r.table_name): r for r in tables.current(spark, root).collect()}
    assert {r.batch_id for r in now.values()} == {"20240102_000000"}
    assert now[("bronze", "inpatient")].table_rows == 1


def findings(spark, root):
    return {r.check_name: r.issue_count for r in tables.read_published(spark, root, "checks")["findings"].collect()}


def test_nothing_is_lost_in_silence(spark, files, tmp_path):  # noqa: F811
    """A line with surplus fields, a cut line, an unknown label, an id in both claim files,
    a key that collides after trimming and a date outside the period: all are findings."""
    from claimward.sources.text import read_all

    given = sources(files)
    providers = [{"Provider": p, "PotentialFraud": f} for p, f in (("P1", "Yes"), ("P2", "No"), ("P3", "Maybe"))]
    people = [BENE | {"BeneID": b} for b in ("B1", " B1", "B2")]
    ip = [IP | {"ClaimID": "C1"}, IP | {"ClaimID": "C2", "ClaimStartDt": "2031-01-05"}]
    op = [OP | {"ClaimID": "C1"}, OP | {"ClaimID": "C3"}]
    last = lines("inpatient", *ip).splitlines()[-1]
    cut = ",".join(last.split(",")[:6])
    broken = lines("inpatient", *ip) + f"{last},surplus,fields\n{cut}\n"
    given |= files(
        provider=lines("provider", *providers),
        inpatient=broken,
        outpatient=lines("outpatient", *op),
        beneficiary=lines("beneficiary", *people),
    )
    root = str(tmp_path / "warehouse")
    period = Expectations(raw={}, period=("2008-11-01", "2009-12-31"))
    with pytest.raises(ValidationError, match="malformed record"):
        refresh.refresh_from_files(spark, given, root, period)
    raw = read_all(spark, given, "20240101_000000")
    refresh.refresh(spark, raw, root, "20240101_000000", period, strict=False)
    found = findings(spark, root)
    named = {name: n for name, n in found.items() if n}
    assert sum(n for name, n in named.items() if name.endswith("malformed record")) == 2
    assert sum(n for name, n in named.items() if name.endswith("unknown label")) == 1
    assert named["stg_claims.claim_id: not unique"] == 1
    assert named["stg_beneficiary.beneficiary_id: not unique"] == 1
    assert named["fact_claims.claim_start_date_key: not in dim_date"] >= 1
    rejects = tables.read_published(spark, root, "checks")["rejects"].collect()
    assert sorted(r.reason for r in rejects) == ["malformed record", "malformed record", "unknown label"]
    star = tables.read_published(spark, root, "gold")
    assert star["dim_date"].count() == 426
    assert {r.year_num for r in star["agg_state_monthly"].collect()} == {2009}


@pytest.fixture(scope="module")
def published(spark):
    from claimward.catalog import intake

    return refresh.published_model(spark, intake.refreshed_root(spark, "/root/testdata/sf0.001"))


def test_every_question_runs_on_published_tables(published):
    from claimward.catalog import business, metric_queries

    for name, (function, _) in {**business.QUERIES, **metric_queries.QUERIES}.items():
        function(published).schema  # noqa: B018
    for name in ("rsk_top_profile", "pop_disease_burden", "gld_agg_provider"):
        assert business.QUERIES[name][0](published).count() > 0, name
    assert metric_queries.QUERIES["met_outlier_providers"][0](published).count() == 1


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    "name", ["fin_cap_scenarios", "ops_kpis", "ops_duration_hist", "exe_ip_op_split", "geo_season"]
)
def test_queries_read_the_fact_alone(published, name):
    from claimward.catalog import business

    assert "Join" not in plan_of(business.QUERIES[name][0](published))


def test_month_filters_skip_files(published):
    from claimward.operators.metrics import metrics

    df = metrics(published, ["total_claims"], filters={"year_num": [1996], "month_num": [1]})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert plan.count("claim_month") > 1
