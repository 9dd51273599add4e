"""Named metrics over a filtered claims set, and metrics that follow the calendar.

``metrics(model, names, by, filters)`` turns any selection into one filter, one group-by
and one aggregate. Ratios without a divisor are 0 here, as on a report card; the business
queries leave them NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from claimward.config import STANDARD, RiskThresholds
from claimward.functions.columns import (
    amount_when,
    choose,
    is_inpatient,
    is_outpatient,
    mean,
    ratio_or_zero,
    same_day,
    steps,
)
from claimward.model import MONTH_KEY, PROVIDER, ClaimsModel, name_months, with_month
from claimward.operators.gold import cents
from claimward.plans.risk import FACTORS, tier
from claimward.session import materialize

AMOUNT = "claim_reimbursement_amt"
Filters = dict[str, Iterable]


def _rows() -> Column:
    return F.count(F.lit(1))


def _amount() -> Column:
    return F.coalesce(F.sum(AMOUNT), F.lit(0).cast("bigint"))


def _flagged() -> Column:
    return F.col("is_potential_fraud")


def _providers() -> Column:
    return F.count_distinct("provider_key")


def _fraud_providers() -> Column:
    return F.expr("count(distinct provider_key) filter (where is_potential_fraud)")


METRICS: dict[str, Callable[[], Column]] = {
    "total_claims": _rows,
    "total_reimbursement": _amount,
    "total_deductible": lambda: F.sum("deductible_amt_paid").cast("double"),
    "total_providers": _providers,
    "total_beneficiaries": lambda: F.count_distinct("beneficiary_key"),
    "avg_reimbursement_per_claim": lambda: ratio_or_zero(_amount(), _rows()),
    "avg_reimbursement_per_beneficiary": lambda: ratio_or_zero(
        _amount(), F.count_distinct("beneficiary_key")
    ),
    "avg_claim_duration_days": lambda: mean("claim_duration_days"),
    "avg_diagnosis_codes": lambda: mean("diagnosis_code_count"),
    "diagnosis_padding_score": lambda: mean("diagnosis_code_count"),
    "avg_length_of_stay": lambda: mean(F.when(is_inpatient(), F.col("admission_duration_days"))),
    "fraud_providers": _fraud_providers,
    "high_risk_provider_count": _fraud_providers,
    "fraud_rate": lambda: ratio_or_zero(_fraud_providers(), _providers()),
    "fraud_reimbursement": lambda: amount_when(_flagged()),
    "fraud_reimbursement_share": lambda: ratio_or_zero(amount_when(_flagged()), _amount()),
    "non_fraud_reimbursement": lambda: amount_when(~_flagged()),
    "deceased_patient_claims": lambda: F.count_if("is_deceased"),
    "zero_reimbursement_claims": lambda: F.count_if("is_zero_reimbursement"),
    "same_day_discharge_count": lambda: F.count_if(same_day()),
    "same_day_discharge_rate": lambda: ratio_or_zero(
        F.count_if(same_day()), F.count_if(is_inpatient())
    ),
    "ip_claims": lambda: F.count_if(is_inpatient()),
    "op_claims": lambda: F.count_if(is_outpatient()),
    "ip_reimbursement": lambda: amount_when(is_inpatient()),
    "op_reimbursement": lambda: amount_when(is_outpatient()),
    "ip_avg_reimbursement": lambda: ratio_or_zero(
        amount_when(is_inpatient()), F.count_if(is_inpatient())
    ),
    "op_avg_reimbursement": lambda: ratio_or_zero(
        amount_when(is_outpatient()), F.count_if(is_outpatient())
    ),
}

#: Dimension columns that a metric reads besides the fact.
READS = {"deceased_patient_claims": ("is_deceased",)}

# Names offered by the metric switch, in this order.
SWITCH = {
    "Total Claims": "total_claims",
    "Total Reimbursement": "total_reimbursement",
    "Avg Reimbursement Per Claim": "avg_reimbursement_per_claim",
    "Fraud Rate %": "fraud_rate",
    "Provider Risk Score": "provider_risk_score",
    "Deceased Patient Claims": "deceased_patient_claims",
}


def filtered(claims: DataFrame, filters: Filters | None) -> DataFrame:
    """Keep rows whose columns take one of the chosen values; scans see the predicates."""
    for name, values in (filters or {}).items():
        claims = claims.filter(F.col(name).isin(*list(values)))
    return claims


def metrics(
    model: ClaimsModel,
    names: list[str],
    by: list[str] | None = None,
    filters: Filters | None = None,
) -> DataFrame:
    """The named metrics, one row per combination of ``by`` (or a single row)."""
    unknown = [name for name in names if name not in METRICS]
    if unknown:
        raise KeyError(f"unknown metrics {unknown}")
    return grouped(model, by or [], [METRICS[name]().alias(name) for name in names], names, filters)


def grouped(
    model: ClaimsModel,
    by: list[str],
    measures: list[Column],
    names: list[str],
    filters: Filters | None,
) -> DataFrame:
    """Measures per combination of ``by``, over claims joined with what is asked for only.

    Provider labels and month names belong to the finished rows: grouping goes by provider
    key and by month number.
    """
    by_provider = "provider_id" in by
    late = set(PROVIDER if by_provider else ()) | {"month_name", "year_month"} & set(by)
    keys = [name for name in by if name not in late]
    if late & {"month_name", "year_month"}:
        keys += [name for name in MONTH_KEY if name not in keys]
    if by_provider:
        keys.append("provider_key")
    wanted = {*keys, *(filters or {}), *(c for n in names for c in READS.get(n, ()))} - {"provider_key"}
    rows = with_month(model.claims_with(wanted))
    if {"month_name", "year_month"} & set(filters or {}):
        rows = name_months(rows)
    result = filtered(rows, filters).groupBy(*keys).agg(*measures)
    made = [name for name in result.columns if name not in keys]
    if late & {"month_name", "year_month"}:
        result = name_months(result)
    if by_provider:
        result = result.join(model.providers.select("provider_key", *PROVIDER), "provider_key")
    return result.select(*by, *made)


def without_provider_filters(filters: Filters | None) -> Filters:
    return {k: v for k, v in (filters or {}).items() if k not in {"provider_key", *PROVIDER}}


def by_name(
    model: ClaimsModel,
    label: str | None,
    by: list[str] | None = None,
    filters: Filters | None = None,
) -> DataFrame:
    """One metric chosen by its display name (the amount if none), as ``selected_metric``.

    The risk score treats each group as if it were one provider, with the label factor
    only where the group holds a single label.
    """
    name = SWITCH.get(label or "Total Reimbursement", "total_reimbursement")
    if name != "provider_risk_score":
        return metrics(model, [name], by, filters).withColumnRenamed(name, "selected_metric")
    return group_scores(model, by or [], filters).select(
        *(by or []), F.col("risk_score").alias("selected_metric")
    )


def switch_values(
    model: ClaimsModel, by: list[str] | None = None, filters: Filters | None = None
) -> DataFrame:
    """All metrics of the switch side by side: one row per group and metric name.

    The plain metrics share one pass over the claims; each finished group row then becomes
    a row per name.
    """
    by = by or []
    plain = [name for name in SWITCH.values() if name != "provider_risk_score"]
    values = metrics(model, plain, by, filters)
    scores = group_scores(model, by, filters).select(*by, F.col("risk_score").alias("provider_risk_score"))
    if by:
        values, scores = values.alias("v"), scores.alias("s")
        same = [F.col(f"v.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by]
        both = values.join(scores, reduce(lambda a, b: a & b, same)).select("v.*", "s.provider_risk_score")
    else:
        both = values.withColumn("provider_risk_score", scores.scalar())
    rows = [
        F.struct(
            F.lit(place).alias("sort_order"),
            F.lit(label).alias("metric_name"),
            F.col(name).cast("double").alias("selected_metric"),
        )
        for place, (label, name) in enumerate(SWITCH.items(), 1)
    ]
    return both.select(*by, F.inline(F.array(*rows)))


def _factor_columns(limits: RiskThresholds) -> dict[str, Column]:
    """Factors over report ratios: distance from the average, zero where undefined."""
    distance = [(bound - 1, points) for bound, points in zip(limits.reimbursement, (3, 2, 1))]
    values = {
        "reimbursement_signal": steps("vs_benchmark", distance, 0),
        "deceased_signal": steps(
            "deceased_patient_claims", list(zip(limits.deceased, (3, 2, 1))), 0
        ),
        "same_day_signal": steps("same_day_discharge_rate", list(zip(limits.same_day, (2, 1))), 0),
        "padding_signal": steps("diagnosis_padding_score", list(zip(limits.padding, (2, 1))), 0),
        "fraud_label_signal": F.when(F.col("only_flagged"), limits.label_points).otherwise(0),
    }
    return values


def group_scores(
    model: ClaimsModel,
    by: list[str],
    filters: Filters | None = None,
    limits: RiskThresholds = STANDARD,
) -> DataFrame:
    """Risk metrics per group: ratios, five factors, score and tier.

    The benchmark is the average per claim under the same filters except those on the
    provider itself.
    """
    names = [
        "total_claims",
        "total_reimbursement",
        "avg_reimbursement_per_claim",
        "deceased_patient_claims",
        "ip_claims",
        "same_day_discharge_count",
        "same_day_discharge_rate",
        "diagnosis_padding_score",
    ]
    measures = [METRICS[name]().alias(name) for name in names]
    measures.append(F.bool_and("is_potential_fraud").alias("only_flagged"))
    groups = materialize(grouped(model, by, measures, names, filters))
    open_filters = without_provider_filters(filters)
    if open_filters == dict(filters or {}):
        everything = groups.agg(ratio_or_zero(F.sum("total_reimbursement"), F.sum("total_claims")))
    else:
        everything = metrics(model, ["avg_reimbursement_per_claim"], filters=open_filters)
    total = sum((F.col(name) for name in FACTORS[1:]), F.col(FACTORS[0]))
    base, own = F.col("global_avg_reimbursement"), F.col("avg_reimbursement_per_claim")
    return (
        groups.withColumn("global_avg_reimbursement", everything.scalar())
        .withColumn("vs_benchmark", ratio_or_zero(own - base, base))
        .withColumns(_factor_columns(limits))
        .withColumn("risk_score", total)
        .withColumn("risk_category", tier("risk_score"))
        .withColumn("payment_decision", payment_decision())
        .drop("only_flagged")
    )


def payment_decision() -> Column:
    """Hold, review or pay, from volume, same-day rate and code padding."""
    quick = F.col("same_day_discharge_rate") > 0.10
    padded = F.coalesce(F.col("diagnosis_padding_score") > 8.5, F.lit(False))
    return choose(
        [
            (F.col("total_claims") < 5, "Insufficient Volume"),
            (quick & padded, "Payment Hold"),
            (quick | padded, "Pre-Payment Review"),
        ],
        "Standard Processing",
    )


def provider_scores(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return group_scores(model, list(PROVIDER), filters)


def global_average(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Average per claim, deaf to provider filters."""
    return metrics(
        model, ["avg_reimbursement_per_claim"], filters=without_provider_filters(filters)
    ).withColumnRenamed("avg_reimbursement_per_claim", "global_avg_reimbursement")


def benchmark_gap(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Each provider's distance from the global average as a ratio."""
    return provider_scores(model, filters).select(
        *PROVIDER, "avg_reimbursement_per_claim", "global_avg_reimbursement", "vs_benchmark"
    )


def risk_scores(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return provider_scores(model, filters).select(*PROVIDER, *FACTORS, "risk_score")


def risk_tiers(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return provider_scores(model, filters).select("provider_id", "risk_score", "risk_category")


def reconciliation(model: ClaimsModel) -> DataFrame:
    """Providers whose score is not the sum of its factors (must be none)."""
    gap = F.col("risk_score") - sum((F.col(name) for name in FACTORS[1:]), F.col(FACTORS[0]))
    return (
        provider_scores(model)
        .withColumn("gap", gap)
        .agg(F.count(F.lit(1)).alias("providers"), F.count_if(F.col("gap") != 0).alias("mismatches"))
    )


TIER_COUNTS = {
    "critical_providers": "Critical",
    "high_risk_providers": "High",
    "medium_risk_providers": "Medium",
    "low_risk_providers": "Low",
    "clean_providers": "Clean",
}


def tier_counts(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Providers per tier in one row."""
    return provider_scores(model, filters).agg(
        *[F.count_if(F.col("risk_category") == t).alias(name) for name, t in TIER_COUNTS.items()]
    )


def outlier_providers(model: ClaimsModel) -> DataFrame:
    """Providers whose own average (to the cent) exceeds 1.5 times the global average."""
    stored = model.rollups.get("agg_provider_summary")
    if stored is not None:
        base = stored.agg(ratio_or_zero(F.sum("total_reimbursement"), F.sum("total_claims"))).scalar()
        own = F.col("avg_reimbursement_per_claim").cast("double")
        return stored.agg(F.count_if(own > base * 1.5).alias("outlier_providers"))
    per_provider = materialize(
        model.fact.groupBy("provider_key").agg(
            F.sum(AMOUNT).alias("amount"),
            F.count(AMOUNT).alias("paid"),
            F.count(F.lit(1)).alias("claims"),
        )
    )
    base = per_provider.agg(ratio_or_zero(F.sum("amount"), F.sum("claims"))).scalar()
    own = cents(F.col("amount"), F.col("paid"), "decimal(12,2)").cast("double")
    return per_provider.agg(F.count_if(own > base * 1.5).alias("outlier_providers"))


# --- calendar metrics ----------------------------------------------------------------


def month_index() -> Column:
    """Consecutive number of a calendar month, so that gaps stay visible."""
    return F.col("year_num") * 12 + F.col("month_num")


def calendar_months(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Per month: change to the previous calendar month, year to date, last three months.

    Windows run over value ranges of the month number, not over rows, so a month without
    claims is not skipped. The input has twelve rows a year.
    """
    months = metrics(
        model, ["total_claims", "total_reimbursement"], ["year_num", "month_num"], filters
    ).withColumn("month_no", month_index())
    line = Window.orderBy("month_no")
    year = Window.partitionBy("year_num").orderBy("month_num")
    amount = F.col("total_reimbursement")
    before = F.sum(amount).over(line.rangeBetween(-1, -1))
    quarter = line.rangeBetween(-2, 0)
    return (
        months.withColumn("prev_calendar_month", before)
        .withColumn(
            "reimbursement_mom",
            ratio_or_zero(amount - F.col("prev_calendar_month"), "prev_calendar_month"),
        )
        .withColumn(
            "reimbursement_ytd", F.sum(amount).over(year.rowsBetween(Window.unboundedPreceding, 0))
        )
        .withColumn("claims_rolling_3m", F.sum("total_claims").over(quarter))
        .withColumn("reimbursement_rolling_3m", F.sum(amount).over(quarter))
        .drop("month_no")
    )


def month_over_month(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return calendar_months(model, filters).select(
        "year_num", "month_num", "total_reimbursement", "prev_calendar_month", "reimbursement_mom"
    )


def year_to_date(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return calendar_months(model, filters).select(
        "year_num", "month_num", "total_reimbursement", "reimbursement_ytd"
    )


def rolling_claims(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return calendar_months(model, filters).select(
        "year_num", "month_num", "total_claims", "claims_rolling_3m"
    )


def rolling_amount(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return calendar_months(model, filters).select(
        "year_num", "month_num", "total_reimbursement", "reimbursement_rolling_3m"
    )


def rolling_by_day(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Claims and amount of the three calendar months that end on each day with claims.

    A gap-free running total per day is looked up twice: at the day, and at the same day
    three months earlier. One row per calendar day, so one task may run the total.
    """
    daily = materialize(
        filtered(with_month(model.claims_with(filters or ())), filters)
        .groupBy("claim_start_date")
        .agg(F.count(F.lit(1)).alias("claims"), F.sum(AMOUNT).alias("amount"))
    )
    span = daily.agg(
        F.explode(
            F.sequence(F.add_months(F.min("claim_start_date"), -4), F.max("claim_start_date"))
        ).alias("day")
    )
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    running = (
        span.join(daily, span.day == daily.claim_start_date, "left")
        .select(
            "day",
            "claim_start_date",
            F.coalesce(F.sum("claims").over(so_far), F.lit(0)).alias("claims_to_date"),
            F.coalesce(F.sum("amount").over(so_far), F.lit(0)).alias("amount_to_date"),
        )
    )
    start = running.select(
        F.col("day").alias("start_day"),
        F.col("claims_to_date").alias("claims_before"),
        F.col("amount_to_date").alias("amount_before"),
    )
    return (
        running.filter("claim_start_date is not null")
        .withColumn("start_day", F.add_months("day", -3))
        .join(start, "start_day")
        .select(
            "claim_start_date",
            (F.col("claims_to_date") - F.col("claims_before")).alias("claims_rolling_3m"),
            (F.col("amount_to_date") - F.col("amount_before")).alias("reimbursement_rolling_3m"),
        )
    )


# --- one-line texts ------------------------------------------------------------------


def alert_texts(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    one = metrics(model, ["fraud_rate", "deceased_patient_claims"], filters=filters)
    rate, deceased = F.col("fraud_rate"), F.col("deceased_patient_claims")
    return one.select(
        choose([(rate > 0.12, "HIGH ALERT"), (rate > 0.08, "MONITOR")], "NORMAL").alias(
            "fraud_rate_rag"
        ),
        F.when(
            deceased > 0,
            F.concat(F.format_number(deceased, 0), F.lit(" Claims from Deceased Patients")),
        )
        .otherwise("No Deceased Patient Claims")
        .alias("deceased_claims_alert"),
    )


def exposure_text(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    one = metrics(model, ["fraud_reimbursement", "fraud_reimbursement_share"], filters=filters)
    return one.select(
        F.format_string(
            "Fraud Exposure: $%s (%.1f%% of total)",
            F.format_number("fraud_reimbursement", 0),
            F.col("fraud_reimbursement_share") * 100,
        ).alias("fraud_exposure_summary")
    )
