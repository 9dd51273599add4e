import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from claimward.config import CONDITION_FLAGS  # noqa: E402
from claimward.model import ClaimsModel  # noqa: E402
from claimward.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "claimward-tests",
        "local[4]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star_model(spark):
    from claimward.sources import star

    return star.model(spark, SF_DIR)


PEOPLE = (
    "beneficiary_key bigint, beneficiary_id string, gender string, patient_age int, age_group string, "
    "is_deceased boolean, date_of_birth date, date_of_death date, state_code int, "
    "chronic_condition_count int, ip_annual_reimbursement_amt bigint, "
    "op_annual_reimbursement_amt bigint, " + ", ".join(f"{f} int" for f in CONDITION_FLAGS)
)


@pytest.fixture
def make_model(spark):
    """A model from short handwritten rows.

    claims: (claim_id, provider, patient, type, day, amount, stay, codes)
    providers: {id: flagged}; patients: {id: dict of traits}; states: {code: (name, region)}
    """

    def build(claims, providers, patients=None, states=None):
        patients = patients or {1: {}}
        states = states or {1: ("Alabama", "South")}
        dim_provider = spark.createDataFrame(
            [(k, k, v, "Fraud" if v else "Not Fraud") for k, v in providers.items()],
            "provider_key bigint, provider_id bigint, is_potential_fraud boolean, fraud_label string",
        )
        rows = []
        for key, traits in patients.items():
            flags = [int(f in traits.get("flags", ())) for f in CONDITION_FLAGS]
            died = traits.get("died")
            rows.append(
                (key, f"B{key}", traits.get("gender", "Male"), 70, "65+", died is not None,
                 dt.date(1939, 1, 1), died, traits.get("state", 1),
                 traits.get("conditions", sum(flags)), traits.get("ip_cost", 0),
                 traits.get("op_cost", 0), *flags)
            )
        dim_beneficiary = spark.createDataFrame(rows, PEOPLE)
        dim_geography = spark.createDataFrame(
            [(code, code, name, name[:2].upper(), region) for code, (name, region) in states.items()],
            "geo_key int, state_code int, state_name string, state_abbr string, region string",
        )
        lines = []
        for claim_id, provider, patient, kind, day, amount, stay, codes in claims:
            inpatient = kind == "Inpatient"
            lines.append(
                (claim_id, provider, patient, kind, day, amount, 1.0, stay,
                 stay if inpatient else None, codes, 0,
                 amount == 0, (stay == 0) if inpatient else None, f"D{codes}")
            )
        fact = spark.createDataFrame(
            lines,
            "claim_id string, provider_key bigint, beneficiary_key bigint, claim_type string, "
            "claim_start_date date, claim_reimbursement_amt bigint, deductible double, "
            "claim_duration_days int, admission_duration_days int, diagnosis_code_count int, "
            "procedure_code_count int, is_zero_reimbursement boolean, is_same_day_discharge boolean, "
            "attending_physician_id string",
        ).selectExpr("*", "cast(deductible as decimal(10,2)) as deductible_amt_paid")
        flags = dim_provider.select("provider_key", "is_potential_fraud")
        return ClaimsModel(
            fact.join(flags, "provider_key"), dim_provider, dim_beneficiary, dim_geography
        )

    return build


def day(text):
    return dt.date.fromisoformat(text)


def as_dict(df, key):
    return {row[key]: row.asDict() for row in df.collect()}
