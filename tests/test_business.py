"""Cases the generated data does not contain, on handwritten claims."""

import pytest
from conftest import as_dict, day

from claimward.config import STRICT
from claimward.operators import decisions, gold, metrics
from claimward.plans import executive, financial, operations, population, reports, risk

D = day("2009-01-15")


def many(prefix, n, provider, kind="Outpatient", amount=100, stay=1, codes=1, patient=1, when=D):
    return [(f"{prefix}{i}", provider, patient, kind, when, amount, stay, codes) for i in range(n)]


def test_clean_tier_and_missing_inpatient_ratio(make_model):
    model = make_model(many("a", 6, 1) + many("b", 6, 2, amount=110), {1: False, 2: True})
    got = as_dict(risk.watchlist(model), "provider_id")
    assert got[1]["risk_category"] == "Clean" and got[1]["same_day_discharge_pct"] is None
    assert got[2]["risk_score"] == 5 and got[2]["risk_category"] == "Medium"
    assert got[2]["investigation_priority"] == 1
    counts = metrics.tier_counts(model).collect()[0]
    assert (counts.clean_providers, counts.medium_risk_providers) == (1, 1)
    rate = as_dict(decisions.payment_holds(model), "provider_id")[1]["same_day_discharge_rate"]
    assert rate == 0.0  # reports show zero where queries show nothing


def test_every_factor_at_its_bound(make_model):
    claims = (
        many("base", 96, 1, amount=100)
        + many("x", 8, 2, amount=1000, codes=10)
        + many("y", 20, 3, kind="Inpatient", amount=100, stay=3)
        + many("z", 2, 3, kind="Inpatient", amount=100, stay=0)
        + many("dead", 11, 4, patient=2)
    )
    model = make_model(
        claims, {1: False, 2: True, 3: False, 4: False}, {1: {}, 2: {"died": day("2009-01-01")}}
    )
    got = as_dict(risk.factors(model), "provider_id")
    assert got[2]["reimbursement_signal"] == 3 and got[2]["padding_signal"] == 2
    assert got[2]["risk_score"] == 10 and got[2]["evidence_score"] == 5
    assert got[3]["same_day_signal"] == 1  # 2 of 22 is above 5 % and not above 10 %
    assert got[4]["deceased_signal"] == 3
    strict = as_dict(risk.factors(model, STRICT), "provider_id")
    assert strict[4]["deceased_signal"] == 2 and strict[3]["same_day_signal"] == 1
    assert metrics.reconciliation(model).collect()[0].mismatches == 0
    summary = as_dict(risk.tier_summary(model), "risk_category")
    assert sum(r["provider_count"] for r in summary.values()) == 4
    assert sum(r["pct_of_providers"] for r in summary.values()) == pytest.approx(100)


def test_payment_decisions(make_model):
    claims = (
        many("few", 4, 1, codes=10)
        + many("hold", 5, 2, kind="Inpatient", stay=0, codes=9)
        + many("pad", 5, 3, codes=9)
        + many("std", 5, 4)
    )
    model = make_model(claims, dict.fromkeys((1, 2, 3, 4), False))
    got = {k: v["payment_decision"] for k, v in as_dict(decisions.payment_holds(model), "provider_id").items()}
    assert got == {1: "Insufficient Volume", 2: "Payment Hold", 3: "Pre-Payment Review", 4: "Standard Processing"}
    assert decisions.under_review_amount(model).collect()[0].under_review_amount == 1000
    assert [r.provider_id for r in reports.hold_list(model).collect()] == [2]


def test_month_without_claims(make_model):
    claims = many("a", 1, 1, when=day("2009-01-10"), amount=100) + many("b", 1, 1, when=day("2009-03-10"), amount=300)
    model = make_model(claims, {1: False})
    by_row = as_dict(executive.monthly_trend(model), "month_num")
    assert by_row[3]["prev_month_reimbursement"] == 100 and by_row[3]["reimbursement_mom_pct"] == 200
    by_calendar = as_dict(metrics.calendar_months(model), "month_num")
    assert by_calendar[3]["prev_calendar_month"] is None and by_calendar[3]["reimbursement_mom"] == 0
    assert by_calendar[3]["reimbursement_rolling_3m"] == 400
    assert by_calendar[3]["reimbursement_ytd"] == 400
    daily = as_dict(metrics.rolling_by_day(model), "claim_start_date")
    assert daily[day("2009-03-10")]["reimbursement_rolling_3m"] == 400


def test_claims_before_and_after_death(make_model):
    died = day("2009-02-01")
    claims = many("b", 1, 1, when=day("2009-01-10")) + many("a", 1, 2, when=day("2009-02-02")) + many("s", 1, 1, when=died)
    row = population.deceased_claims(make_model(claims, {1: False, 2: True}, {1: {"died": died}})).collect()[0]
    assert (row.deceased_patient_claims, row.claims_started_after_death, row.fraud_providers_involved) == (3, 1, 1)
    assert row.days_after_death_first_claim == -22


def test_unmapped_and_unknown_states(make_model):
    people = {1: {"state": 1}, 2: {"state": 40}, 3: {"state": 54}}
    claims = many("a", 2, 1, patient=1) + many("b", 1, 1, patient=2) + many("c", 1, 1, patient=3)
    model = make_model(claims, {1: False}, people, {1: ("Alabama", "South"), 54: ("Other", "Unknown")})
    from claimward.plans import geography

    regions = as_dict(geography.regions(model), "region")
    assert set(regions) == {"South"}
    assert regions["South"]["pct_of_national_claims"] == 50  # the total keeps unmapped claims
    months = gold.state_month_rollup(model).collect()
    assert {r.state_code for r in months} == {1, 54, gold.UNMAPPED_STATE}
    assert set(as_dict(geography.states(model), "state_name")) == {"Alabama", "Other"}


def test_missing_amounts_differ_between_mean_and_metric(make_model):
    model = make_model(many("a", 1, 1, amount=100) + many("n", 1, 1, amount=None), {1: False})
    assert executive.portfolio(model).collect()[0].avg_reimbursement_per_claim == 100
    metric = metrics.metrics(model, ["avg_reimbursement_per_claim"]).collect()[0]
    assert metric.avg_reimbursement_per_claim == 50


def test_durations_and_the_last_bucket(make_model):
    claims = [c for i, d in enumerate((0, 1, 4, 8, 15, 31, None)) for c in many(f"d{i}", 1, 1, stay=d)]
    got = as_dict(operations.duration_histogram(make_model(claims, {1: False})), "duration_bucket")
    assert {k: v["claim_count"] for k, v in got.items()} == {
        "0 days (Same Day)": 1, "1-3 days": 1, "4-7 days": 1, "8-14 days": 1, "15-30 days": 1, "30+ days": 2,
    }


def test_care_management(make_model):
    flags = ("has_cancer", "has_stroke")
    people = {
        1: {"conditions": 6, "ip_cost": 9000, "op_cost": 1000, "flags": flags},
        2: {"conditions": 6, "ip_cost": 9999},
        3: {"conditions": 9, "ip_cost": 50000, "flags": flags},
        4: {"conditions": 1},
    }
    claims = many("a", 1, 1, patient=1) + many("b", 1, 1, patient=2) + many("d", 1, 1, patient=4)
    model = make_model(claims, {1: False}, people)
    got = {k: v["care_priority"] for k, v in as_dict(decisions.care_priority(model), "beneficiary_id").items()}
    assert got == {"B1": "High Priority", "B2": "Moderate Priority", "B3": "No Claims in Scope", "B4": "Standard Care"}
    assert decisions.care_pool(model).collect()[0].high_priority_beneficiaries == 1
    assert decisions.care_savings(model).collect()[0].projected_savings == pytest.approx(1200)
    assert decisions.care_capacity(model, 0).collect()[0].recommended_enrollment == 0
    counts = {r.disease_name: r.beneficiary_count for r in decisions.disease_counts(model).collect()}
    assert len(counts) == 11 and counts["Cancer"] == 1 and counts["COPD"] == 0
    everyone = {r.disease_name: r.total_beneficiaries for r in gold.disease_rollup(model).collect()}
    assert everyone == {"Cancer": 2, "Stroke": 2}


def test_top_n_default_selects_nothing_and_ties_share_a_place(make_model):
    model = make_model(many("a", 1, 1) + many("b", 1, 2) + many("c", 1, 3, amount=50), dict.fromkeys((1, 2, 3), False))
    assert decisions.top_n_providers(model).count() == 0
    assert {r.provider_id for r in decisions.top_n_providers(model, 1).collect()} == {1, 2}


def test_what_ifs_are_monotone(star_model):
    grid = sorted(decisions.cap_series(star_model).collect(), key=lambda r: r.cap_amount)
    savings = [r.potential_savings for r in grid]
    assert savings == sorted(savings, reverse=True) and len(grid) == 10
    steps = sorted(decisions.threshold_series(star_model).collect(), key=lambda r: r.threshold)
    providers = [r.providers_above_threshold for r in steps]
    assert providers == sorted(providers, reverse=True) and len(steps) == 15


def test_rollups_and_shares_agree_with_the_claims(star_model):
    total = executive.portfolio(star_model).collect()[0]
    rollup = gold.provider_rollup(star_model).agg({"total_reimbursement": "sum", "total_claims": "sum"}).collect()[0]
    assert rollup["sum(total_reimbursement)"] == total.total_reimbursement
    assert rollup["sum(total_claims)"] == total.total_claims
    drivers = financial.cost_drivers(star_model).groupBy("dimension").sum("reimbursement_pct").collect()
    assert len(drivers) == 4 and all(r[1] == pytest.approx(100) for r in drivers)
    cube = reports.drill(star_model).filter("grouping_level = 15").collect()
    assert cube[0].total_reimbursement == total.total_reimbursement
    pivot = reports.month_year_pivot(star_model).filter("month_name = 'Total'").collect()
    assert pivot[0].total == total.total_reimbursement


def test_filters_reach_the_scan(star_model):
    plan = reports.sliced(star_model, {"region": ["ASIA"], "claim_type": ["Outpatient"]})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ASIA" in text and "isnotnull(r_name" in text
    assert "c_name" not in text and "l_shipdate" not in text  # unused columns are not read


def test_unknown_names_are_refused(star_model):
    with pytest.raises(KeyError):
        metrics.metrics(star_model, ["no_such_metric"])
    with pytest.raises(ValueError):
        risk.tier_summary(star_model, mode="other")
    with pytest.raises(ValueError):
        population.kpis(star_model, grain="other")
