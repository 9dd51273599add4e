"""Validation gates of the three layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from claimward.config import CONDITION_FLAGS
from claimward.functions.columns import (
    INPATIENT,
    OUTPATIENT,
    age_tier,
    is_blank,
    mean,
    percent,
)
from claimward.operators.gold import unmatched_claims
from claimward.operators.profile import NAMES, as_date, as_number, rows_per_key, trimmed
from claimward.operators.tally import (
    CRITICAL,
    WARNING,
    Check,
    as_checks,
    enforce,
    measured,
    named_count,
    orphan_rows,
    tally,
    union_all,
)
from claimward.schemas import AMOUNT_COLUMNS, DATASETS, DATE_COLUMNS, REQUIRED

Tables = dict[str, DataFrame]
AGE_GROUPS = ["Below 45", "45-54", "55-64", "65+"]


def _rows() -> Column:
    return F.count(F.lit(1))


# --- bronze --------------------------------------------------------------------------


def bronze(df: DataFrame, dataset: str, expected: int | None = None) -> DataFrame:
    """Row count, required columns, duplicate keys (critical); dates, amounts (warning)."""
    table = NAMES[dataset]
    findings: list[tuple[str, Column, str]] = []
    if expected is not None:
        findings.append((f"{table}: row count", F.abs(_rows() - expected), CRITICAL))
    for name in REQUIRED[dataset]:
        findings.append((f"{table}.{name}: missing", F.count_if(is_blank(name)), CRITICAL))
    for name in DATE_COLUMNS[dataset]:
        bad = (F.coalesce(trimmed(name), F.lit("")) != "NA") & as_date(name).isNull()
        findings.append((f"{table}.{name}: not a date", F.count_if(bad), WARNING))
    for name in AMOUNT_COLUMNS[dataset]:
        findings.append((f"{table}.{name}: negative", F.count_if(as_number(name) < 0), WARNING))
    counts = measured(
        df, [(name, {"issue_count": count}) for name, count, _ in findings], "check_name"
    )
    # only the key is shuffled for the duplicates; all other counts need no shuffle
    surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint"))
    repeated = rows_per_key(df, dataset).agg(surplus.alias("issue_count"))
    duplicates = named_count(repeated, f"{table}: duplicate key rows")
    levels = [F.lit(part) for name, _, level in findings for part in (name, level)]
    return as_checks(
        counts, "bronze", F.create_map(*levels)[F.col("check_name")]
    ).unionByName(as_checks(duplicates, "bronze", CRITICAL))


def bronze_all(raw: Tables, expected: dict[str, int]) -> DataFrame:
    return union_all([bronze(raw[n], n, expected.get(n)) for n in DATASETS])


# --- silver --------------------------------------------------------------------------


def silver_counts(silver: Tables, expected: dict[str, int]) -> DataFrame:
    """Rows of the staging tables, claims also by type."""
    typed = silver["stg_claims"].groupBy("claim_type").agg(_rows().alias("row_count"))
    per_type = typed.select(
        F.concat(F.lit("stg_claims ("), "claim_type", F.lit(")")).alias("table_name"), "row_count"
    )
    totals = [
        silver[name].agg(F.lit(name).alias("table_name"), _rows().alias("row_count"))
        for name in ("stg_provider", "stg_beneficiary", "stg_claims")
    ]
    return _against(union_all([*totals, per_type]), expected)


def _against(counts: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Row counts next to their expectations (none where nothing is expected)."""
    pairs = [F.lit(part) for name, count in expected.items() for part in (name, count)]
    wanted = (
        F.create_map(*pairs)[F.col("table_name")].cast("bigint")
        if pairs
        else F.lit(None).cast("bigint")
    )
    return counts.withColumn("expected", wanted).withColumn(
        "matched", F.col("expected").isNull() | (F.col("row_count") == F.col("expected"))
    )


Groups = dict[str, list[Check]]


def _run(layer: str, tables: Tables, *groups: Groups) -> DataFrame:
    """All checks of all groups, one pass per table."""
    merged: Groups = {}
    for group in groups:
        for table, found in group.items():
            merged.setdefault(table, []).extend(found)
    return union_all([tally(tables[table], layer, found) for table, found in merged.items()])


# Columns that must be filled in the staging tables.
FILLED = {
    "stg_provider": ["provider_id", "is_potential_fraud"],
    "stg_beneficiary": [
        "beneficiary_id",
        "date_of_birth",
        "gender",
        "patient_age",
        "age_group",
        "is_deceased",
        "chronic_condition_count",
    ],
    "stg_claims": [
        "claim_id",
        "beneficiary_id",
        "provider_id",
        "claim_type",
        "claim_start_date",
        "claim_end_date",
        "claim_reimbursement_amt",
    ],
}


def _null_checks() -> Groups:
    """Missing ids are critical, other missing values are reported."""
    return {
        table: [
            (f"{table}.{c}: null", F.col(c).isNull(), CRITICAL if c.endswith("_id") else WARNING)
            for c in names
        ]
        for table, names in FILLED.items()
    }


def silver_nulls(silver: Tables) -> DataFrame:
    return _run("silver", silver, _null_checks())


def _domain_checks() -> Groups:
    bad_flag = reduce(lambda a, b: a | b, [~F.col(c).isin(0, 1) for c in CONDITION_FLAGS])
    outside = {
        "stg_provider": {
            "fraud flag outside true/false": ~F.col("is_potential_fraud").cast("int").isin(0, 1),
        },
        "stg_beneficiary": {
            "gender outside Male/Female": ~F.col("gender").isin("Male", "Female"),
            "age group unknown": ~F.col("age_group").isin(*AGE_GROUPS),
            "renal indicator outside 0/1": ~F.col("renal_disease_indicator").isin(0, 1),
            "condition flags outside 0/1": bad_flag,
        },
        "stg_claims": {
            "claim type unknown": ~F.col("claim_type").isin(INPATIENT, OUTPATIENT),
            "zero flag outside true/false": ~F.col("is_zero_reimbursement").cast("int").isin(0, 1),
        },
    }
    return _warnings(outside)


def _warnings(named: dict[str, dict[str, Column]]) -> Groups:
    return {
        table: [(f"{table}: {name}", bad, WARNING) for name, bad in found.items()]
        for table, found in named.items()
    }


def silver_domains(silver: Tables) -> DataFrame:
    return _run("silver", silver, _domain_checks())


def silver_distinct(silver: Tables) -> DataFrame:
    """Distinct values of five columns."""
    columns = {
        "is_potential_fraud": "stg_provider",
        "gender": "stg_beneficiary",
        "age_group": "stg_beneficiary",
        "claim_type": "stg_claims",
        "is_deceased": "stg_beneficiary",
    }
    return union_all(
        [
            silver[table]
            .select(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value"))
            .distinct()
            for name, table in columns.items()
        ]
    )


def _derived_checks() -> Groups:
    age, group = F.col("patient_age"), F.col("age_group")
    flag_sum = sum((F.col(c) for c in CONDITION_FLAGS[1:]), F.col(CONDITION_FLAGS[0]))
    inpatient = F.col("claim_type") == INPATIENT
    outpatient = F.col("claim_type") == OUTPATIENT
    stay = F.date_diff("discharge_date", "admission_date")
    length = F.date_diff("claim_end_date", "claim_start_date")
    amount = F.col("claim_reimbursement_amt")
    return _warnings(
        {
            "stg_beneficiary": {
                "age group does not fit age": age.isNotNull() & (group != age_tier(age)),
                "death flag does not fit death date": F.col("is_deceased")
                != F.col("date_of_death").isNotNull(),
                "condition count is not the flag sum": F.col("chronic_condition_count") != flag_sum,
            },
            "stg_claims": {
                "duration is not the date difference": F.col("claim_duration_days") != length,
                "stay is not the date difference": inpatient
                & (F.col("admission_duration_days") != stay),
                "zero flag does not fit amount": F.col("is_zero_reimbursement") != (amount == 0),
                "same-day flag does not fit dates": inpatient
                & (F.col("is_same_day_discharge") != (stay == 0)),
                "outpatient with admission date": outpatient & F.col("admission_date").isNotNull(),
                "outpatient with same-day flag": outpatient
                & F.col("is_same_day_discharge").isNotNull(),
            },
        }
    )


def silver_derived(silver: Tables) -> DataFrame:
    """Derived columns recomputed from the columns they come from."""
    return _run("silver", silver, _derived_checks())


def silver_references(silver: Tables) -> DataFrame:
    """Claims without a staged patient or provider (they will not reach the fact)."""
    found = [
        named_count(
            orphan_rows(silver["stg_claims"], key, silver[parent], key),
            f"stg_claims.{key}: not in {parent}",
        )
        for key, parent in (
            ("beneficiary_id", "stg_beneficiary"),
            ("provider_id", "stg_provider"),
        )
    ]
    return as_checks(union_all(found), "silver", WARNING)


# Columns in which the placeholder was replaced.
CLEANED = {
    "stg_claims": [
        "attending_physician_id",
        "operating_physician_id",
        "other_physician_id",
        "diagnosis_code_1",
        "procedure_code_1",
        "deductible_amt_paid",
    ],
    "stg_beneficiary": ["date_of_death"],
}


def _placeholder_checks() -> Groups:
    return {
        table: [
            (f"{table}.{c}: placeholder left", F.col(c).cast("string") == "NA", CRITICAL)
            for c in names
        ]
        for table, names in CLEANED.items()
    }


def silver_placeholders(silver: Tables) -> DataFrame:
    """No placeholder text may be left anywhere it was replaced."""
    return _run("silver", silver, _placeholder_checks())


def silver_ranges(silver: Tables) -> DataFrame:
    """Smallest, largest and average values, and rows outside the sensible range."""

    def spread(value: Column, outside: Column) -> dict[str, Column]:
        return {
            "min_val": F.min(value).cast("bigint"),
            "max_val": F.max(value).cast("bigint"),
            "avg_val": mean(value),
            "outside": F.count_if(outside),
        }

    def only(kind: str, name: str) -> Column:
        return F.when(F.col("claim_type") == kind, F.col(name))

    amount = "claim_reimbursement_amt"
    conditions = F.col("chronic_condition_count")
    people = [
        ("age", spread(F.col("patient_age"), F.col("patient_age") < 0)),
        ("condition count", spread(conditions, (conditions < 0) | (conditions > 11))),
    ]
    claims = [
        ("claim duration", spread(F.col("claim_duration_days"), F.col("claim_duration_days") < 0)),
        (
            "inpatient duration",
            spread(
                only(INPATIENT, "claim_duration_days"), only(INPATIENT, "claim_duration_days") < 0
            ),
        ),
        ("inpatient amount", spread(only(INPATIENT, amount), only(INPATIENT, amount) < 0)),
        ("outpatient amount", spread(only(OUTPATIENT, amount), only(OUTPATIENT, amount) < 0)),
    ]
    return measured(silver["stg_beneficiary"], people, "metric").unionByName(
        measured(silver["stg_claims"], claims, "metric")
    )


def tier_shares(beneficiaries: DataFrame) -> DataFrame:
    """Patients per age tier with their share (four rows)."""
    return (
        beneficiaries.groupBy("age_group")
        .agg(_rows().alias("beneficiary_count"))
        .withColumn(
            "pct",
            F.round(
                F.col("beneficiary_count")
                * 100
                / F.sum("beneficiary_count").over(Window.partitionBy()),
                2,
            ),
        )
    )


def _fact(metric: str, item: str | Column, value: str | Column) -> list[Column]:
    return [
        F.lit(metric).alias("metric"),
        (F.lit(item) if isinstance(item, str) else item).alias("item"),
        (F.col(value) if isinstance(value, str) else value).cast("double").alias("value"),
    ]


def silver_business(silver: Tables) -> DataFrame:
    """Rates and counts a reviewer looks at before the star is built."""
    claims = silver["stg_claims"]
    zero = F.coalesce(F.sum(F.col("is_zero_reimbursement").cast("int")), F.lit(0))
    tiers = tier_shares(silver["stg_beneficiary"])
    return union_all(
        [
            silver["stg_provider"].agg(
                *_fact("fraud provider %", "all", percent(F.count_if("is_potential_fraud"), _rows()))
            ),
            silver["stg_beneficiary"].agg(
                *_fact("deceased beneficiary %", "all", percent(F.count_if("is_deceased"), _rows()))
            ),
            claims.filter(F.col("claim_type") == INPATIENT).agg(
                *_fact("same-day discharges", "all", F.count_if("is_same_day_discharge"))
            ),
            claims.groupBy("claim_type")
            .agg(zero.alias("zeros"))
            .select(*_fact("zero reimbursement", F.col("claim_type"), "zeros")),
            tiers.select(*_fact("age group count", F.col("age_group"), "beneficiary_count")),
            tiers.select(*_fact("age group %", F.col("age_group"), "pct")),
        ]
    )


#: Keys that must be unique once text is trimmed and unquoted, per layer.
SILVER_KEYS = {
    "stg_provider": ["provider_id"],
    "stg_beneficiary": ["beneficiary_id"],
    "stg_claims": ["claim_id"],
}
GOLD_KEYS = {
    "dim_provider": ["provider_id", "provider_key"],
    "dim_beneficiary": ["beneficiary_id", "beneficiary_key"],
    "dim_geography": ["geo_key"],
    "dim_date": ["date_key"],
    "fact_claims": ["claim_id"],
}


def _unique(layer: str, tables: Tables, keys: dict[str, list[str]]) -> DataFrame:
    """Surplus rows of every key; keys are counted inside the tasks first."""
    surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint"))
    counts = [
        named_count(
            tables[table].groupBy(key).agg(_rows().alias("n")).agg(surplus.alias("issue_count")),
            f"{table}.{key}: not unique",
        )
        for table, names in keys.items()
        for key in names
    ]
    return as_checks(union_all(counts), layer, CRITICAL)


def silver_unique(silver: Tables) -> DataFrame:
    """Cleaned keys that occur more than once; claim ids over both claim files."""
    return _unique("silver", silver, SILVER_KEYS)


def gold_unique(gold: Tables) -> DataFrame:
    return _unique("gold", gold, GOLD_KEYS)


def rejected(rejects: DataFrame) -> DataFrame:
    """Rejected records per dataset and reason, each kind critical."""
    kinds = [(dataset, "malformed record") for dataset in DATASETS] + [("provider", "unknown label")]
    rows = [
        (
            f"{NAMES[dataset]}: {reason}",
            {"issue_count": F.count_if((F.col("dataset") == dataset) & (F.col("reason") == reason))},
        )
        for dataset, reason in kinds
    ]
    return as_checks(measured(rejects, rows, "check_name"), "bronze", CRITICAL)


def left_out(silver: Tables) -> DataFrame:
    """Claims that the joins of the fact will leave out."""
    lost = unmatched_claims(silver["stg_claims"], silver["stg_provider"], silver["stg_beneficiary"])
    counts = lost.select(
        F.lit("stg_claims: left out of the fact").alias("check_name"),
        F.col("dropped_claims").alias("issue_count"),
    )
    return as_checks(counts, "silver", WARNING)


def silver_gate(silver: Tables) -> DataFrame:
    """All silver checks with the uniform result: one pass per table, plus keys and references."""
    groups = [_null_checks(), _domain_checks(), _derived_checks(), _placeholder_checks()]
    return union_all(
        [
            _run("silver", silver, *groups),
            silver_references(silver),
            silver_unique(silver),
            left_out(silver),
        ]
    )


# --- gold ----------------------------------------------------------------------------


def gold_counts(gold: Tables, expected: dict[str, int]) -> DataFrame:
    counts = [
        df.agg(F.lit(name).alias("table_name"), _rows().alias("row_count"))
        for name, df in gold.items()
    ]
    return _against(union_all(counts), expected)


FACT_KEYS = {
    "provider_key": ("dim_provider", "provider_key"),
    "beneficiary_key": ("dim_beneficiary", "beneficiary_key"),
    "claim_start_date_key": ("dim_date", "date_key"),
}


# A claim whose start date was no date keeps its place in the fact without a date key.
KEY_LEVELS = {
    "provider_key": CRITICAL,
    "beneficiary_key": CRITICAL,
    "claim_start_date_key": WARNING,
}


def _missing_key_checks() -> Groups:
    return {
        "fact_claims": [
            (f"fact_claims.{key}: null", F.col(key).isNull(), level)
            for key, level in KEY_LEVELS.items()
        ]
    }


def _gold_orphans(gold: Tables) -> DataFrame:
    fact = gold["fact_claims"]
    return union_all(
        [
            as_checks(
                named_count(
                    orphan_rows(fact.filter(F.col(key).isNotNull()), key, gold[table], parent_key),
                    f"fact_claims.{key}: not in {table}",
                ),
                "gold",
                KEY_LEVELS[key],
            )
            for key, (table, parent_key) in FACT_KEYS.items()
        ]
    )


def gold_references(gold: Tables) -> DataFrame:
    """Fact keys without a dimension row, and missing fact keys."""
    return _gold_orphans(gold).unionByName(_run("gold", gold, _missing_key_checks()))


def _fact_checks() -> Groups:
    def null(name: str, level: str) -> Check:
        return (f"fact_claims.{name}: null", F.col(name).isNull(), level)

    unknown = ~F.col("claim_type").isin(INPATIENT, OUTPATIENT)
    return {
        "fact_claims": [
            ("fact_claims: claim type unknown", unknown, WARNING),
            null("claim_type", CRITICAL),
            null("is_potential_fraud", WARNING),
            null("claim_reimbursement_amt", WARNING),
        ]
    }


def gold_fact(gold: Tables) -> DataFrame:
    """Completeness of the fact."""
    return _run("gold", gold, _fact_checks())


def gold_fact_types(gold: Tables) -> DataFrame:
    return gold["fact_claims"].groupBy("claim_type").agg(_rows().alias("row_count"))


def _dim_checks() -> Groups:
    def null(table: str, name: str) -> Check:
        return (f"{table}.{name}: null", F.col(name).isNull(), WARNING)

    return {
        "dim_provider": [
            (
                "dim_provider: fraud flag outside true/false",
                ~F.col("is_potential_fraud").cast("int").isin(0, 1),
                WARNING,
            ),
            (
                "dim_provider: label unknown",
                ~F.col("fraud_label").isin("Fraud", "Not Fraud"),
                WARNING,
            ),
        ],
        "dim_beneficiary": [
            null("dim_beneficiary", "patient_age"),
            null("dim_beneficiary", "age_group"),
        ],
        "dim_geography": [null("dim_geography", "state_name")],
        "dim_date": [null("dim_date", "year_month")],
    }


def gold_dims(gold: Tables) -> DataFrame:
    return _run("gold", gold, _dim_checks())


def gold_rollup(gold: Tables) -> DataFrame:
    """Fact totals against the provider rollup: both differences must be zero."""
    zero = F.lit(0).cast("bigint")
    rollup = gold["agg_provider_summary"].agg(
        F.struct(
            F.coalesce(F.sum("total_reimbursement"), zero).alias("amount"),
            F.coalesce(F.sum("total_claims"), zero).alias("claims"),
        )
    )
    both = gold["fact_claims"].agg(
        F.coalesce(F.sum("claim_reimbursement_amt"), zero).alias("amount"), _rows().alias("claims")
    ).withColumn("rollup", rollup.scalar())
    rows = F.array(
        *[
            F.struct(
                F.lit(f"agg_provider_summary: {name} differ from fact").alias("check_name"),
                F.abs(F.col(name) - F.col(f"rollup.{name}")).alias("issue_count"),
            )
            for name in ("amount", "claims")
        ]
    )
    return as_checks(both.select(F.inline(rows)), "gold", CRITICAL)


def gold_kpis(gold: Tables) -> DataFrame:
    """Fraud rate, claim totals by type, age tiers, states per region, calendar span."""
    by_type = gold["fact_claims"].groupBy("claim_type").agg(
        _rows().alias("claims"),
        F.sum("claim_reimbursement_amt").alias("amount"),
        mean("claim_reimbursement_amt").alias("average"),
    )
    tiers = tier_shares(gold["dim_beneficiary"])
    regions = (
        gold["dim_geography"]
        .filter("region <> 'Unknown'")
        .groupBy("region")
        .agg(F.count_distinct("state_code").alias("states"))
    )
    kind = F.col("claim_type")
    return union_all(
        [
            gold["dim_provider"].agg(
                *_fact("fraud provider %", "all", percent(F.count_if("is_potential_fraud"), _rows()))
            ),
            by_type.select(*_fact("claims", kind, "claims")),
            by_type.select(*_fact("amount", kind, "amount")),
            by_type.select(*_fact("average amount", kind, "average")),
            tiers.select(*_fact("age group count", F.col("age_group"), "beneficiary_count")),
            tiers.select(*_fact("age group %", F.col("age_group"), "pct")),
            regions.select(*_fact("states", F.col("region"), "states")),
            gold["dim_date"].agg(*_fact("first date key", "all", F.min("date_key"))),
            gold["dim_date"].agg(*_fact("last date key", "all", F.max("date_key"))),
            gold["dim_date"].agg(*_fact("calendar days", "all", _rows())),
        ]
    )


def gold_spots(gold: Tables, limit: int = 5) -> DataFrame:
    """Largest providers and states, and diseases by prevalence."""

    def spot(df: DataFrame, kind: str, item: str, count: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("spot"),
            F.col(item).alias("item"),
            F.col(count).cast("bigint").alias("row_count"),
            F.col("total_reimbursement").cast("bigint").alias("total_reimbursement"),
        )

    providers = (
        gold["agg_provider_summary"]
        .orderBy(F.desc_nulls_last("total_reimbursement"), "provider_id")
        .limit(limit)
    )
    states = (
        gold["agg_state_monthly"]
        .groupBy("state_name")
        .agg(
            F.sum("total_reimbursement").alias("total_reimbursement"),
            F.sum("total_claims").alias("total_claims"),
        )
        .orderBy(F.desc_nulls_last("total_reimbursement"), "state_name")
        .limit(limit)
    )
    return union_all(
        [
            spot(providers, "provider", "provider_id", "total_claims"),
            spot(states, "state", "state_name", "total_claims"),
            spot(gold["agg_chronic_disease"], "disease", "disease_name", "total_beneficiaries"),
        ]
    )


def gold_gate(gold: Tables) -> DataFrame:
    """All gold checks with the uniform result: one pass per table, plus the joins."""
    rows = _run("gold", gold, _missing_key_checks(), _fact_checks(), _dim_checks())
    return union_all([rows, _gold_orphans(gold), gold_rollup(gold), gold_unique(gold)])


__all__ = [
    "bronze",
    "bronze_all",
    "enforce",
    "gold_counts",
    "gold_dims",
    "gold_fact",
    "gold_fact_types",
    "gold_gate",
    "gold_kpis",
    "gold_references",
    "gold_rollup",
    "gold_spots",
    "gold_unique",
    "left_out",
    "rejected",
    "silver_business",
    "silver_counts",
    "silver_derived",
    "silver_distinct",
    "silver_domains",
    "silver_gate",
    "silver_nulls",
    "silver_placeholders",
    "silver_ranges",
    "silver_references",
    "silver_unique",
    "tier_shares",
]
