"""Data sets behind report pages that no business query already covers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimward.functions.columns import is_inpatient, share
from claimward.model import MONTH_KEY, PROVIDER, STATE, ClaimsModel, name_months, with_month
from claimward.operators import lattice
from claimward.operators.decisions import (
    HIGH_PRIORITY,
    REVIEWED,
    care_priority,
    payment_holds,
)
from claimward.operators.metrics import (
    Filters,
    by_name,
    filtered,
    metrics,
    provider_scores,
)
from claimward.plans.risk import FACTORS
from claimward.session import materialize

AMOUNT = "claim_reimbursement_amt"
DRILL = ["fraud_label", "claim_type", "region", "age_group"]


def drill(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Amount for every drill path over the four attributes.

    Claims are added up per full combination first (a few hundred rows at any scale, from
    the smallest stored set that holds them), and only those rows are repeated for the sixteen
    grouping sets of the cube.
    """
    combos = lattice.answer(model, ["total_claims", "total_reimbursement"], DRILL, filters)
    return combos.cube(*DRILL).agg(
        F.grouping_id().alias("grouping_level"),
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_reimbursement").alias("total_reimbursement"),
    )


def label_type_mix(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Amount by label and claim type in percent of the label (four rows)."""
    return metrics(model, ["total_reimbursement"], ["fraud_label", "claim_type"], filters).withColumn(
        "pct_of_label", share("total_reimbursement", "fraud_label")
    )


def month_year_pivot(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Months against years with totals in both directions.

    Years are those of the stored calendar, else of the month table (twelve rows a year),
    which is stored first, so finding them does not read the claims again. Claims without a
    date or outside the calendar have no place in the table.
    """
    months = materialize(
        metrics(
            model, ["total_reimbursement"], ["month_num", "month_name", "year_num"], filters
        )
    )
    dated = model.calendar if model.calendar is not None else months.filter("year_num is not null")
    years = [row[0] for row in dated.select("year_num").distinct().orderBy("year_num").collect()]
    body = months.filter(F.col("year_num").isin(years)).groupBy("month_num", "month_name").pivot("year_num", years).agg(
        F.sum("total_reimbursement")
    )
    named = body.select(
        "month_num", "month_name", *[F.col(f"`{year}`").alias(f"y{year}") for year in years]
    )
    columns = [f"y{year}" for year in years]
    total_row = named.agg(
        F.lit(None).cast("int").alias("month_num"),
        F.lit("Total").alias("month_name"),
        *[F.sum(name).alias(name) for name in columns],
    )
    zero = F.lit(0).cast("bigint")
    row_total = sum((F.coalesce(F.col(name), zero) for name in columns), zero)
    return named.unionByName(total_row).withColumn("total", row_total)


def stay_histogram(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Inpatient claims by exact length of stay."""
    return (
        filtered(with_month(model.claims_with(filters or ())), filters)
        .filter(is_inpatient() & F.col("admission_duration_days").isNotNull())
        .groupBy("admission_duration_days")
        .agg(F.count(F.lit(1)).alias("total_claims"))
    )


def code_histogram(model: ClaimsModel, provider_id: object | None = None) -> DataFrame:
    """Claims by number of diagnosis codes, for every provider or for one."""
    chosen = {} if provider_id is None else {"provider_id": [provider_id]}
    return metrics(model, ["total_claims"], ["provider_id", "diagnosis_code_count"], chosen)


def age_gender(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return metrics(model, ["total_beneficiaries"], ["age_group", "gender"], filters)


def state_metric_top(
    model: ClaimsModel, label: str | None = None, n: int = 15, filters: Filters | None = None
) -> DataFrame:
    """Leading states by a metric chosen by name."""
    return (
        by_name(model, label, ["state_name"], filters)
        .filter("state_name is not null")
        .orderBy(F.desc_nulls_last("selected_metric"), "state_name")
        .limit(n)
    )


def top_sets(model: ClaimsModel) -> DataFrame:
    """The ranked lists of the report pages under one roof.

    Every list is a bounded top-k over one stored provider table and one state table.
    """
    scores = provider_scores(model).select(
        F.col("provider_id").cast("string").alias("item"),
        F.col("total_reimbursement").cast("double").alias("amount"),
        F.col("total_claims").cast("double").alias("claims"),
        F.col("diagnosis_padding_score").alias("codes"),
        F.col("risk_score").cast("double").alias("score"),
    )
    stored = materialize(scores)
    states = metrics(model, ["total_reimbursement"], list(STATE)).select(
        F.col("state_name").alias("item"),
        F.col("total_reimbursement").cast("double").alias("amount"),
    )

    def leading(df: DataFrame, name: str, value: str, n: int) -> DataFrame:
        return (
            df.filter("item is not null")
            .select(F.lit(name).alias("set_name"), "item", F.col(value).alias("value"))
            .orderBy(F.desc_nulls_last("value"), "item")
            .limit(n)
        )

    lists = [
        leading(states, "top 10 states by amount", "amount", 10),
        leading(stored, "top 50 providers by amount", "amount", 50),
        leading(stored, "top 100 providers by amount", "amount", 100),
        leading(stored, "top 100 providers by claims", "claims", 100),
        leading(stored, "top 20 providers by codes", "codes", 20),
        leading(stored, "top 20 providers by score", "score", 20),
    ]
    result = lists[0]
    for other in lists[1:]:
        result = result.unionByName(other)
    return result


def hold_list(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return payment_holds(model, filters).filter(F.col("payment_decision") == "Payment Hold")


def hold_scatter(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Held or reviewed providers: same-day rate against average codes."""
    return (
        payment_holds(model, filters)
        .filter((F.col("total_claims") >= 5) & F.col("payment_decision").isin(*REVIEWED))
        .select(
            "provider_id", "payment_decision", "same_day_discharge_rate", "diagnosis_padding_score"
        )
    )


def care_list(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return care_priority(model, filters).filter(F.col("care_priority") == HIGH_PRIORITY)


def deceased_list(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Deceased patients with their claims and amount."""
    traits = ["is_deceased", "beneficiary_id", "date_of_death"]
    rows = filtered(with_month(model.claims_with([*traits, *(filters or ())])), filters).filter("is_deceased")
    return rows.groupBy("beneficiary_id", "date_of_death").agg(
        F.count(F.lit(1)).alias("total_claims"), F.sum(AMOUNT).alias("total_reimbursement")
    )


def _one(provider_id: object | None) -> Column:
    return F.lit(True) if provider_id is None else F.col("provider_id") == provider_id


def provider_profile(model: ClaimsModel, provider_id: object | None = None) -> DataFrame:
    """Header of the provider page. The benchmark always covers all providers."""
    return (
        provider_scores(model)
        .filter(_one(provider_id))
        .select(
            *PROVIDER,
            "total_claims",
            "total_reimbursement",
            *FACTORS,
            "risk_score",
            "risk_category",
            "payment_decision",
        )
    )


def provider_months(model: ClaimsModel, provider_id: object | None = None) -> DataFrame:
    """Monthly line of the provider page."""
    months = (
        with_month(model.joined("provider"))
        .filter(_one(provider_id))
        .groupBy("provider_id", *MONTH_KEY)
        .agg(F.count(F.lit(1)).alias("total_claims"), F.sum(AMOUNT).alias("total_reimbursement"))
    )
    return name_months(months)


def provider_claims(model: ClaimsModel, provider_id: object | None = None) -> DataFrame:
    """Claim list of the provider page."""
    return model.joined("provider").filter(_one(provider_id)).select(
        "provider_id",
        "claim_id",
        "claim_start_date",
        "claim_type",
        AMOUNT,
        "claim_duration_days",
        "diagnosis_code_count",
        "procedure_code_count",
        "is_same_day_discharge",
    )


def provider_scatter(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    return metrics(
        model,
        ["total_claims", "total_reimbursement", "deceased_patient_claims"],
        ["provider_id", "fraud_label"],
        filters,
    )


def condition_cost(model: ClaimsModel, filters: Filters | None = None) -> DataFrame:
    """Per age group: conditions summed over patients, amount per patient, claims."""
    burden = model.beneficiaries.groupBy("age_group").agg(
        F.sum("chronic_condition_count").alias("condition_sum")
    )
    claims = metrics(
        model, ["avg_reimbursement_per_beneficiary", "total_claims"], ["age_group"], filters
    )
    return burden.join(claims, "age_group", "left")


def sliced(model: ClaimsModel, filters: Filters) -> DataFrame:
    """Headline metrics under any choice of slicer values, per month, from a stored set if one
    holds the chosen columns."""
    return lattice.answer(
        model,
        ["total_claims", "total_reimbursement", "fraud_rate", "avg_reimbursement_per_claim"],
        ["year_num", "month_num"],
        filters,
    )
