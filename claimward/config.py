"""Settings of the claims model: expectations, keys and thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field

# Eleven chronic conditions as (flag column, rollup name, list name).
CONDITIONS = [
    ("has_alzheimer", "Alzheimer", "Alzheimer's"),
    ("has_heart_failure", "Heart Failure", "Heart Failure"),
    ("has_kidney_disease", "Kidney Disease", "Kidney Disease"),
    ("has_cancer", "Cancer", "Cancer"),
    ("has_obstr_pulmonary", "Obstructive Pulmonary", "COPD"),
    ("has_depression", "Depression", "Depression"),
    ("has_diabetes", "Diabetes", "Diabetes"),
    ("has_ischemic_heart", "Ischemic Heart", "Ischemic Heart Disease"),
    ("has_osteoporosis", "Osteoporosis", "Osteoporosis"),
    ("has_rheumatoid_arthritis", "Rheumatoid Arthritis", "Rheumatoid Arthritis"),
    ("has_stroke", "Stroke", "Stroke"),
]
CONDITION_FLAGS = [flag for flag, _, _ in CONDITIONS]

# Fixed value: ages are taken at the end of the data period.
AGE_REFERENCE_DATE = "2009-12-31"
# Days covered by the calendar of the public data set.
CALENDAR_START, CALENDAR_END = "2008-11-01", "2009-12-31"

# Rows of the public data set per raw dataset.
PUBLIC_ROW_COUNTS = {
    "provider": 5410,
    "inpatient": 40474,
    "outpatient": 517737,
    "beneficiary": 138556,
}


@dataclass(frozen=True)
class RiskThresholds:
    """Bounds of the five risk factors; a value must exceed a bound to score."""

    reimbursement: tuple[float, ...] = (3.0, 2.0, 1.5)  # times the average -> 3, 2, 1
    deceased: tuple[int, ...] = (10, 5, 0)  # claims -> 3, 2, 1
    same_day: tuple[float, ...] = (0.10, 0.05)  # share of inpatient claims -> 2, 1
    padding: tuple[float, ...] = (9.5, 8.5)  # average diagnosis codes -> 2, 1
    label_points: int = 5


STANDARD = RiskThresholds()
STRICT = RiskThresholds(deceased=(20, 10, 0), same_day=(0.15, 0.05))

# Lowest score of each risk tier.
RISK_TIERS = [(9, "Critical"), (6, "High"), (3, "Medium"), (1, "Low")]
LOWEST_TIER = "Clean"


@dataclass(frozen=True)
class Expectations:
    """Row counts a run must reproduce; a dataset without an entry is not checked."""

    raw: dict[str, int] = field(default_factory=lambda: dict(PUBLIC_ROW_COUNTS))
    silver: dict[str, int] = field(default_factory=dict)
    gold: dict[str, int] = field(default_factory=dict)
    #: First and last day of the calendar; without it the calendar spans the claims.
    period: tuple[str, str] | None = None

    @classmethod
    def public(cls) -> "Expectations":
        raw = PUBLIC_ROW_COUNTS
        claims = raw["inpatient"] + raw["outpatient"]
        return cls(
            raw=dict(raw),
            period=(CALENDAR_START, CALENDAR_END),
            silver={
                "stg_provider": raw["provider"],
                "stg_beneficiary": raw["beneficiary"],
                "stg_claims": claims,
                "stg_claims (Inpatient)": raw["inpatient"],
                "stg_claims (Outpatient)": raw["outpatient"],
            },
            gold={
                "dim_provider": raw["provider"],
                "dim_beneficiary": raw["beneficiary"],
                "dim_date": 426,
                "dim_geography": 52,
                "fact_claims": claims,
                "agg_provider_summary": raw["provider"],
                "agg_state_monthly": 682,
                "agg_chronic_disease": len(CONDITIONS),
            },
        )

    @classmethod
    def none(cls) -> "Expectations":
        return cls(raw={}, silver={}, gold={})
