"""Text files to staging: every edge case once."""

import pytest
from conftest import as_dict, day
from pyspark.sql import functions as F

from claimward.catalog import intake
from claimward.operators import checks, profile, silver
from claimward.operators.tally import ValidationError, enforce
from claimward.schemas import DATASETS, RAW_COLUMNS
from claimward.sources import text

BLANK = {name: {c: "NA" for c in RAW_COLUMNS[name]} for name in DATASETS}


def lines(dataset, *rows):
    names = RAW_COLUMNS[dataset]
    out = [",".join(names)]
    for row in rows:
        values = {**BLANK[dataset], **row}
        out.append(",".join(str(values[n]) for n in names))
    return "\n".join(out) + "\n"


IP = dict(BeneID="B1", ClaimID="C1", Provider="P1", ClaimStartDt="2009-01-01", ClaimEndDt="2009-01-05",
          AdmissionDt="2009-01-01", DischargeDt="2009-01-05", InscClaimAmtReimbursed="100",
          DeductibleAmtPaid="1068")
OP = {k: v for k, v in IP.items() if k not in ("AdmissionDt", "DischargeDt")} | {"ClaimID": "C9"}
BENE = dict(BeneID="B1", DOB="1940-05-01", Gender="1", RenalDiseaseIndicator="0", State="1", County="10",
            ChronicCond_Cancer="1", IPAnnualReimbursementAmt="10", IPAnnualDeductibleAmt="0",
            OPAnnualReimbursementAmt="5", OPAnnualDeductibleAmt="0")


@pytest.fixture
def files(tmp_path):
    def write(**datasets):
        content = {
            "provider": lines("provider", {"Provider": "P1", "PotentialFraud": "Yes"}),
            "inpatient": lines("inpatient", IP),
            "outpatient": lines("outpatient", OP),
            "beneficiary": lines("beneficiary", BENE),
        } | datasets
        paths = {}
        for name, body in content.items():
            target = tmp_path / f"{name}.csv"
            target.write_text(body)
            paths[name] = str(target)
        return paths

    return write


def test_quoted_comma_doubled_quote_and_placeholder(spark, files):
    paths = files(
        provider='Provider,PotentialFraud\n"P,1",Yes\n"P""2",No\nNA,\n',
    )
    rows = text.read_text(spark, paths["provider"], "provider").collect()
    assert [(r.Provider, r.PotentialFraud) for r in rows] == [("P,1", "Yes"), ('P"2', "No"), ("NA", None)]


def test_other_header_is_an_error(spark, files):
    paths = files(provider="Provider,Label\nP1,Yes\n")
    with pytest.raises(Exception, match="(?i)header"):
        text.read_text(spark, paths["provider"], "provider").collect()


def test_missing_source_is_named(spark, files):
    paths = files() | {"outpatient": "/nowhere/op.csv"}
    with pytest.raises(FileNotFoundError, match="outpatient"):
        text.source_sizes(spark, paths)
    assert text.source_sizes(spark, files()).count() == 4


def test_audit_columns(spark, files):
    row = text.read_all(spark, files(), "20240101_000000")["provider"].collect()[0]
    assert row.batch_id == "20240101_000000"
    assert row.source_file_name == "provider.csv"
    assert row.ingestion_timestamp is not None


def test_beneficiary_edge_cases(spark, files):
    rows = [
        BENE | {"BeneID": "B1", "DOB": "1964-12-31", "DOD": "NA"},
        BENE | {"BeneID": "B2", "DOB": "1965-01-01", "DOD": "2009-02-01", "Gender": "2"},
        BENE | {"BeneID": '""B3""', "DOB": "2009-13-40", "DOD": "junk", "Gender": "3",
                "RenalDiseaseIndicator": "X"},
        BENE | {"BeneID": "B4", "RenalDiseaseIndicator": "Y", "ChronicCond_Cancer": "2",
                "ChronicCond_stroke": "9", "ChronicCond_Diabetes": "", "ChronicCond_Alzheimer": "1"},
    ]
    raw = text.read_text(spark, files(beneficiary=lines("beneficiary", *rows))["beneficiary"], "beneficiary")
    got = as_dict(silver.beneficiary(text.strip_quotes(raw)), "beneficiary_id")
    assert set(got) == {"B1", "B2", "B3", "B4"}
    assert (got["B1"]["patient_age"], got["B1"]["age_group"], got["B1"]["is_deceased"]) == (45, "45-54", False)
    assert (got["B2"]["patient_age"], got["B2"]["age_group"]) == (44, "Below 45")
    assert (got["B2"]["is_deceased"], got["B2"]["date_of_death"], got["B2"]["gender"]) == (
        True, day("2009-02-01"), "Female")
    b3 = got["B3"]
    assert (b3["date_of_birth"], b3["patient_age"], b3["age_group"]) == (None, None, "65+")
    assert (b3["is_deceased"], b3["date_of_death"], b3["gender"], b3["renal_disease_indicator"]) == (
        True, None, None, None)
    b4 = got["B4"]
    assert (b4["renal_disease_indicator"], b4["has_cancer"], b4["has_stroke"], b4["has_diabetes"]) == (1, 0, 0, 0)
    assert b4["chronic_condition_count"] == b4["has_alzheimer"] == 1


def test_claim_edge_cases(spark, files):
    ip = [
        IP | {"ClaimID": "same", "DischargeDt": "2009-01-01", "InscClaimAmtReimbursed": "0"},
        IP | {"ClaimID": "open", "DischargeDt": "", "InscClaimAmtReimbursed": "abc", "DeductibleAmtPaid": "NA"},
        IP | {"ClaimID": "codes", "ClmDiagnosisCode_1": "D1", "ClmDiagnosisCode_2": "",
              "ClmDiagnosisCode_3": " D3 ", "ClmProcedureCode_1": "7", "InscClaimAmtReimbursed": "-5",
              "AttendingPhysician": " PHY "},
    ]
    paths = files(inpatient=lines("inpatient", *ip))
    raw = {n: text.read_text(spark, paths[n], n) for n in ("inpatient", "outpatient")}
    got = as_dict(silver.claims(raw["inpatient"], raw["outpatient"]), "claim_id")
    assert (got["same"]["is_same_day_discharge"], got["same"]["admission_duration_days"]) == (True, 0)
    assert got["same"]["is_zero_reimbursement"] is True
    assert (got["open"]["is_same_day_discharge"], got["open"]["admission_duration_days"]) == (False, None)
    assert (got["open"]["claim_reimbursement_amt"], got["open"]["is_zero_reimbursement"]) == (None, False)
    assert float(got["open"]["deductible_amt_paid"]) == 0.0
    codes = got["codes"]
    assert (codes["diagnosis_code_count"], codes["procedure_code_count"]) == (2, 1)
    assert (codes["diagnosis_code_3"], codes["attending_physician_id"]) == ("D3", "PHY")
    assert codes["operating_physician_id"] is None and codes["claim_reimbursement_amt"] == -5
    op = got["C9"]
    assert [op[c] for c in ("admission_date", "discharge_date", "admission_duration_days",
                            "is_same_day_discharge")] == [None] * 4


def test_unknown_label_is_rejected_not_loaded(spark, files):
    body = "Provider,PotentialFraud\nP1, Yes \nP2,No\nP3,Maybe\n"
    raw = text.read_text(spark, files(provider=body)["provider"], "provider")
    assert as_dict(silver.provider(raw), "provider_id")["P1"]["is_potential_fraud"] is True
    assert silver.provider(raw).count() == 2
    assert [r.provider_id for r in silver.provider_rejects(raw).collect()] == ["P3"]


def test_bronze_gate_levels(spark, files):
    rows = [IP, IP, IP | {"ClaimID": "C2", "BeneID": "", "ClaimStartDt": "2009-13-40",
                          "InscClaimAmtReimbursed": "-5"}]
    raw = text.read_text(spark, files(inpatient=lines("inpatient", *rows))["inpatient"], "inpatient")
    found = as_dict(checks.bronze(raw, "inpatient", expected=2), "check_name")
    table = "raw_inpatient"
    assert found[f"{table}: row count"]["issue_count"] == 1
    assert found[f"{table}.BeneID: missing"]["issue_count"] == 1
    assert found[f"{table}: duplicate key rows"]["issue_count"] == 1
    assert found[f"{table}.ClaimStartDt: not a date"]["severity"] == "warning"
    assert found[f"{table}.InscClaimAmtReimbursed: negative"]["issue_count"] == 1
    assert found[f"{table}.DeductibleAmtPaid: negative"]["passed"] is True
    with pytest.raises(ValidationError, match="duplicate"):
        enforce(checks.bronze(raw, "inpatient", expected=2))
    enforce(checks.bronze(raw.limit(1), "inpatient", expected=1))


def test_profile_counts_and_top_values(spark):
    values = ["a"] * 5 + ["b"] * 3 + ["NA"] * 2 + ["", None] + list("cdef")
    df = spark.createDataFrame([(v, "Yes") for v in values], "Provider string, PotentialFraud string")
    row = as_dict(profile.columns_profile(df, "provider"), "column_name")["Provider"]
    assert (row["null_count"], row["blank_count"], row["na_count"], row["distinct_count"]) == (1, 1, 2, 8)
    assert row["top_values"] == "a=5; b=3; NA=2; =1; c=1"
    total = profile.dataset_profile(df, "provider", 10).collect()[0]
    assert (total.row_count, total.row_count_match, total.pk_duplicates) == (16, False, 16 - 8)


def test_orphans_count_every_row_of_a_hot_missing_key(spark):
    from claimward.operators.tally import orphan_rows

    child = spark.range(90).select(F.when(F.col("id") < 60, "lost").otherwise("known").alias("k"))
    parent = spark.createDataFrame([("known",), ("known",)], "k string")
    assert orphan_rows(child, "k", parent, "k").collect()[0].issue_count == 60


def test_text_queries_ask_for_methods_the_jvm_compiles(spark):
    """A whole stage over thirty text columns is longer than the 8000 bytes the JVM compiles."""
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    intake.raw(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
