"""Stored grouping sets, and the smallest one that answers a request.

The refresh stores sums of the claims by a few sets of columns, the coarser made from the
finer. A request names metrics, group columns and filters; it is answered from the stored
set with the fewest rows that holds all of them, and from the claims where none does. Sums
and counts are added up again; averages and rates are made from the added parts, so results
equal those over the claims. Distinct counts come from key bitmaps stored with the set.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from claimward.functions.columns import amount_when, is_inpatient, is_outpatient, ratio_or_zero, same_day
from claimward.model import MONTH_KEY, STATE, ClaimsModel, name_months, with_month
from claimward.operators import metrics
from claimward.operators.distinct import SETS, distinct_counts, key_bitmaps, with_counts
from claimward.operators.metrics import AMOUNT, Filters, filtered, grouped

MONTH_NAMES = {"month_name", "year_month"}


@dataclass(frozen=True)
class GroupingSet:
    """Columns of a stored set, the finer set it is made from, and whether keys are stored."""

    columns: tuple[str, ...]
    parent: str | None = None
    keys: bool = False


_PATH = ("fraud_label", "claim_type", "region", "age_group", "gender")

#: Finer sets come before those made from them. None grows with the claims but ``provider``,
#: which has two rows a provider.
LATTICE: dict[str, GroupingSet] = {
    "path_month": GroupingSet((*_PATH, *MONTH_KEY), keys=True),
    "path": GroupingSet(_PATH, "path_month", keys=True),
    "type_month": GroupingSet(("fraud_label", "claim_type", *MONTH_KEY), "path_month", keys=True),
    "state_month": GroupingSet((*STATE, "claim_type", *MONTH_KEY)),
    "provider": GroupingSet(("provider_id", "fraud_label", "claim_type")),
}

#: What a set stores: every entry adds up over coarser groups.
SUMS: dict[str, Callable[[], Column]] = {
    "claims": lambda: F.count(F.lit(1)),
    "amount": lambda: F.sum(AMOUNT),
    "deductible": lambda: F.sum("deductible_amt_paid"),
    "duration_days": lambda: F.sum("claim_duration_days"),
    "durations": lambda: F.count("claim_duration_days"),
    "codes": lambda: F.sum("diagnosis_code_count"),
    "coded": lambda: F.count("diagnosis_code_count"),
    "stay_days": lambda: F.sum(F.when(is_inpatient(), F.col("admission_duration_days"))),
    "stays": lambda: F.count(F.when(is_inpatient(), F.col("admission_duration_days"))),
    "flagged_amount": lambda: amount_when(F.col("is_potential_fraud")),
    "unflagged_amount": lambda: amount_when(~F.col("is_potential_fraud")),
    "deceased": lambda: F.count_if("is_deceased"),
    "unpaid": lambda: F.count_if("is_zero_reimbursement"),
    "same_day": lambda: F.count_if(same_day()),
    "inpatient": lambda: F.count_if(is_inpatient()),
    "outpatient": lambda: F.count_if(is_outpatient()),
    "inpatient_amount": lambda: amount_when(is_inpatient()),
    "outpatient_amount": lambda: amount_when(is_outpatient()),
}


def _whole(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint"))


def _rate(part: str, whole: str) -> Column:
    return ratio_or_zero(_whole(part), _whole(whole))


#: Metrics over added sums, by the names of ``metrics.METRICS``.
FROM_SUMS: dict[str, Callable[[], Column]] = {
    "total_claims": lambda: _whole("claims"),
    "total_reimbursement": lambda: _whole("amount"),
    "total_deductible": lambda: F.col("deductible").cast("double"),
    "avg_reimbursement_per_claim": lambda: _rate("amount", "claims"),
    "avg_claim_duration_days": lambda: F.try_divide("duration_days", "durations"),
    "avg_diagnosis_codes": lambda: F.try_divide("codes", "coded"),
    "diagnosis_padding_score": lambda: F.try_divide("codes", "coded"),
    "avg_length_of_stay": lambda: F.try_divide("stay_days", "stays"),
    "fraud_reimbursement": lambda: _whole("flagged_amount"),
    "fraud_reimbursement_share": lambda: _rate("flagged_amount", "amount"),
    "non_fraud_reimbursement": lambda: _whole("unflagged_amount"),
    "deceased_patient_claims": lambda: _whole("deceased"),
    "zero_reimbursement_claims": lambda: _whole("unpaid"),
    "same_day_discharge_count": lambda: _whole("same_day"),
    "same_day_discharge_rate": lambda: _rate("same_day", "inpatient"),
    "ip_claims": lambda: _whole("inpatient"),
    "op_claims": lambda: _whole("outpatient"),
    "ip_reimbursement": lambda: _whole("inpatient_amount"),
    "op_reimbursement": lambda: _whole("outpatient_amount"),
    "ip_avg_reimbursement": lambda: _rate("inpatient_amount", "inpatient"),
    "op_avg_reimbursement": lambda: _rate("outpatient_amount", "outpatient"),
}

#: Metrics over distinct counts; these need the keys of a set.
FROM_KEYS: dict[str, Callable[[], Column]] = {
    "total_providers": lambda: _whole("unique_providers"),
    "total_beneficiaries": lambda: _whole("unique_beneficiaries"),
    "avg_reimbursement_per_beneficiary": lambda: _rate("amount", "unique_beneficiaries"),
    "fraud_providers": lambda: _whole("fraud_providers"),
    "high_risk_provider_count": lambda: _whole("fraud_providers"),
    "fraud_rate": lambda: _rate("fraud_providers", "unique_providers"),
}


def sums_table(name: str) -> str:
    return f"agg_set_{name}"


def keys_table(name: str) -> str:
    return f"agg_set_{name}_keys"


def added(rows: DataFrame, by: list[str]) -> DataFrame:
    """Sums of stored sums per coarser group."""
    return rows.groupBy(*by).agg(*[F.sum(name).alias(name) for name in SUMS])


def stored_sums(model: ClaimsModel, name: str, stored: Mapping[str, DataFrame]) -> DataFrame:
    """The sums of a set, from its parent where that is stored, else from the claims."""
    wanted = LATTICE[name]
    if wanted.parent and sums_table(wanted.parent) in stored:
        return added(stored[sums_table(wanted.parent)], list(wanted.columns))
    made = [column().alias(part) for part, column in SUMS.items()]
    return grouped(model, list(wanted.columns), made, list(metrics.READS), None)


def stored_keys(model: ClaimsModel, name: str, stored: Mapping[str, DataFrame]) -> DataFrame:
    """The key bitmaps of a set, likewise."""
    wanted = LATTICE[name]
    by = list(wanted.columns)
    if wanted.parent and keys_table(wanted.parent) in stored:
        finer = stored[keys_table(wanted.parent)]
        return finer.groupBy(*by, "set_name", "bucket").agg(F.bitmap_or_agg("keys").alias("keys"))
    return key_bitmaps(with_month(model.claims_with(by)), by, SETS)


def build(
    model: ClaimsModel, keep: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]
) -> dict[str, DataFrame]:
    """Every table of the lattice; ``keep`` stores tables and returns them as stored."""
    stored: dict[str, DataFrame] = {}
    for name, wanted in LATTICE.items():
        stored.update(keep({sums_table(name): stored_sums(model, name, stored)}))
        if wanted.keys:
            stored.update(keep({keys_table(name): stored_keys(model, name, stored)}))
    return stored


def smallest(
    model: ClaimsModel, names: list[str], by: list[str], filters: Filters | None = None
) -> str | None:
    """The stored set with the fewest rows that holds a request, None if none does.

    Rows are those of the tables a request would read, as counted when they were stored;
    without counts the set with the fewest columns wins.
    """
    if any(name not in FROM_SUMS and name not in FROM_KEYS for name in names):
        return None
    read = {*by, *(filters or {})}
    if read & MONTH_NAMES:
        read = read - MONTH_NAMES | set(MONTH_KEY)
    by_keys = any(name in FROM_KEYS for name in names)
    sizes = []
    for place, (name, wanted) in enumerate(LATTICE.items()):
        needed = [sums_table(name)] + [keys_table(name)] * by_keys
        if read <= set(wanted.columns) and all(t in model.rollups for t in needed):
            counts = [model.rollup_rows.get(t) for t in needed]
            known = None not in counts
            sizes.append((not known, sum(counts) if known else len(wanted.columns), place, name))
    return min(sizes)[-1] if sizes else None


def answer(
    model: ClaimsModel,
    names: list[str],
    by: list[str] | None = None,
    filters: Filters | None = None,
) -> DataFrame:
    """The rows of ``metrics.metrics``, from the smallest stored set that holds the request."""
    by = by or []
    chosen = smallest(model, names, by, filters)
    if chosen is None:
        return metrics.metrics(model, names, by, filters)
    keys = [name for name in by if name not in MONTH_NAMES]
    if MONTH_NAMES & set(by):
        keys += [name for name in MONTH_KEY if name not in keys]

    def rows(table: str) -> DataFrame:
        df = model.rollups[table]
        return filtered(name_months(df) if MONTH_NAMES & set(filters or {}) else df, filters)

    result = added(rows(sums_table(chosen)), keys)
    if any(name in FROM_KEYS for name in names):
        result = with_counts(result, distinct_counts(rows(keys_table(chosen)), keys, SETS), keys, list(SETS))
    if MONTH_NAMES & set(by):
        result = name_months(result)
    made = {**FROM_SUMS, **FROM_KEYS}
    return result.select(*by, *[made[name]().alias(name) for name in names])


def by_name(
    model: ClaimsModel,
    label: str | None,
    by: list[str] | None = None,
    filters: Filters | None = None,
) -> DataFrame:
    """One metric by its display name, as ``metrics.by_name``, from a stored set if one holds it.

    The risk score needs more than sums and is made from the claims.
    """
    name = metrics.SWITCH.get(label or "Total Reimbursement", "total_reimbursement")
    if name == "provider_risk_score":
        return metrics.by_name(model, label, by, filters)
    return answer(model, [name], by, filters).withColumnRenamed(name, "selected_metric")
