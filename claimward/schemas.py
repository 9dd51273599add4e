"""Declared layouts: nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

DIAGNOSIS_COLUMNS = [f"ClmDiagnosisCode_{i}" for i in range(1, 11)]
PROCEDURE_COLUMNS = [f"ClmProcedureCode_{i}" for i in range(1, 7)]

# Text layouts of the four raw files, in file order.
CHRONIC_COLUMNS = [
    "ChronicCond_Alzheimer",
    "ChronicCond_Heartfailure",
    "ChronicCond_KidneyDisease",
    "ChronicCond_Cancer",
    "ChronicCond_ObstrPulmonary",
    "ChronicCond_Depression",
    "ChronicCond_Diabetes",
    "ChronicCond_IschemicHeart",
    "ChronicCond_Osteoporasis",
    "ChronicCond_rheumatoidarthritis",
    "ChronicCond_stroke",
]
RAW_COLUMNS = {
    "provider": ["Provider", "PotentialFraud"],
    "inpatient": [
        "BeneID",
        "ClaimID",
        "ClaimStartDt",
        "ClaimEndDt",
        "Provider",
        "InscClaimAmtReimbursed",
        "AttendingPhysician",
        "OperatingPhysician",
        "OtherPhysician",
        "AdmissionDt",
        "ClmAdmitDiagnosisCode",
        "DeductibleAmtPaid",
        "DischargeDt",
        "DiagnosisGroupCode",
        *DIAGNOSIS_COLUMNS,
        *PROCEDURE_COLUMNS,
    ],
    "outpatient": [
        "BeneID",
        "ClaimID",
        "ClaimStartDt",
        "ClaimEndDt",
        "Provider",
        "InscClaimAmtReimbursed",
        "AttendingPhysician",
        "OperatingPhysician",
        "OtherPhysician",
        *DIAGNOSIS_COLUMNS,
        *PROCEDURE_COLUMNS,
        "ClmAdmitDiagnosisCode",
        "DeductibleAmtPaid",
    ],
    "beneficiary": [
        "BeneID",
        "DOB",
        "DOD",
        "Gender",
        "Race",
        "RenalDiseaseIndicator",
        "State",
        "County",
        "NoOfMonths_PartACov",
        "NoOfMonths_PartBCov",
        *CHRONIC_COLUMNS,
        "IPAnnualReimbursementAmt",
        "IPAnnualDeductibleAmt",
        "OPAnnualReimbursementAmt",
        "OPAnnualDeductibleAmt",
    ],
}
DATASETS = list(RAW_COLUMNS)
AUDIT_COLUMNS = ["ingestion_timestamp", "source_file_name", "batch_id"]
CORRUPT = "_corrupt_record"

# Key and required columns of each raw dataset.
PRIMARY_KEYS = {
    "provider": ["Provider"],
    "inpatient": ["ClaimID"],
    "outpatient": ["ClaimID"],
    "beneficiary": ["BeneID"],
}
# Roles of columns: dates and amounts of each raw dataset.
DATE_COLUMNS = {
    "provider": [],
    "inpatient": ["ClaimStartDt", "ClaimEndDt", "AdmissionDt", "DischargeDt"],
    "outpatient": ["ClaimStartDt", "ClaimEndDt"],
    "beneficiary": ["DOB", "DOD"],
}
AMOUNT_COLUMNS = {
    "provider": [],
    "inpatient": ["InscClaimAmtReimbursed", "DeductibleAmtPaid"],
    "outpatient": ["InscClaimAmtReimbursed", "DeductibleAmtPaid"],
    "beneficiary": [
        "IPAnnualReimbursementAmt",
        "IPAnnualDeductibleAmt",
        "OPAnnualReimbursementAmt",
        "OPAnnualDeductibleAmt",
    ],
}
REQUIRED = {
    "provider": ["Provider", "PotentialFraud"],
    "inpatient": ["BeneID", "ClaimID", "Provider"],
    "outpatient": ["BeneID", "ClaimID", "Provider"],
    "beneficiary": ["BeneID", "DOB", "Gender"],
}


def text_schema(dataset: str) -> T.StructType:
    """All columns as text, plus the column that takes rows the reader cannot split."""
    names = [*RAW_COLUMNS[dataset], CORRUPT]
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])
