"""The given star tables rendered as the four raw text datasets.

The rules below are plain SQL expressions with the same meaning in Spark and in any other
engine. They also plant every kind of dirt that intake has to cope with: placeholders,
blanks, stray quotes, impossible dates, negative amounts, unknown keys and labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimward.schemas import CHRONIC_COLUMNS, RAW_COLUMNS
from claimward.sources.star import order_lines, table

BASE_RULES = {
    "started": "CAST(o_orderdate AS DATE)",
    "inpatient": "l_returnflag = 'R' AND l_partkey % 4 = 0",
    "amount": "CASE WHEN l_partkey % 27 = 0 THEN 0 ELSE CAST(floor(l_extendedprice / 10) AS BIGINT) * "
    "CASE WHEN l_suppkey % 20 = 3 THEN 5 WHEN l_suppkey % 20 = 0 THEN 3 "
    "WHEN l_suppkey % 20 = 7 THEN 2 ELSE 1 END END",
    "days": "CASE WHEN l_suppkey % 5 = 1 AND l_linenumber = 1 THEN 0 ELSE CAST(l_quantity AS INT) % 36 END",
    "codes": "CASE WHEN l_suppkey % 7 = 0 THEN 9 + l_partkey % 2 ELSE 1 + l_partkey % 9 END",
    "procs": "l_partkey % 4",
}
CLAIM_RULES = {
    "BeneID": "CASE WHEN l_orderkey % 53 = 0 THEN concat('BENEX', o_custkey) ELSE concat('BENE', o_custkey) END",
    "ClaimID": "concat('CLM', l_orderkey, '-', l_linenumber)",
    "ClaimStartDt": "CASE WHEN l_orderkey % 101 = 0 THEN '2009-13-40' ELSE CAST(started AS STRING) END",
    "ClaimEndDt": "CASE WHEN l_orderkey % 67 = 0 THEN CAST(started - 2 AS STRING) "
    "WHEN l_orderkey % 103 = 0 THEN '' ELSE CAST(started + days AS STRING) END",
    "Provider": "CASE WHEN l_partkey % 59 = 0 THEN concat('PRVX', l_suppkey) ELSE concat('PRV', l_suppkey) END",
    "InscClaimAmtReimbursed": "CASE WHEN l_partkey % 113 = 0 THEN 'abc' WHEN l_partkey % 127 = 0 THEN '-5' "
    "ELSE CAST(amount AS STRING) END",
    "AttendingPhysician": "CASE WHEN l_partkey % 11 = 0 THEN 'NA' ELSE concat('PHY', l_partkey % 50) END",
    "OperatingPhysician": "CASE WHEN l_linenumber % 2 = 0 THEN 'NA' ELSE concat(' PHY', l_suppkey % 30) END",
    "OtherPhysician": "CASE WHEN l_linenumber % 3 <> 0 THEN 'NA' WHEN l_partkey % 13 = 0 THEN '' "
    "ELSE concat('PHY', l_partkey % 20) END",
    "AdmissionDt": "CASE WHEN l_orderkey % 71 = 0 THEN '' ELSE CAST(started AS STRING) END",
    "ClmAdmitDiagnosisCode": "concat('A', l_partkey % 40)",
    "DeductibleAmtPaid": "CASE WHEN l_linenumber = 5 THEN 'NA' WHEN l_partkey % 131 = 0 THEN 'x' "
    "ELSE concat(CAST(round(l_tax * 100) AS INT), '.25') END",
    "DischargeDt": "CASE WHEN l_orderkey % 73 = 0 THEN 'NA' WHEN l_orderkey % 79 = 0 THEN CAST(started - 1 AS STRING) "
    "ELSE CAST(started + days AS STRING) END",
    "DiagnosisGroupCode": "concat('G', l_partkey % 30)",
    **{
        f"ClmDiagnosisCode_{i}": f"CASE WHEN {i} > codes THEN 'NA' WHEN (l_partkey + {i}) % 37 = 0 THEN '' "
        f"ELSE concat('D', (l_partkey + {i}) % 900) END"
        for i in range(1, 11)
    },
    **{
        f"ClmProcedureCode_{i}": f"CASE WHEN {i} > procs THEN 'NA' ELSE concat('P', (l_partkey + {i}) % 90) END"
        for i in range(1, 7)
    },
}
_SPECIAL_FLAGS = {
    "ChronicCond_Alzheimer": "WHEN c_custkey % 173 = 0 THEN '9' ",
    "ChronicCond_stroke": "WHEN c_custkey % 179 = 0 THEN '' ",
    "ChronicCond_Diabetes": "WHEN c_custkey % 16 = 0 THEN ' 1' ",
}
BENEFICIARY_RULES = {
    "BeneID": "CASE WHEN c_custkey % 41 = 0 THEN concat('\"BENE', c_custkey, '\"') ELSE concat('BENE', c_custkey) END",
    "DOB": "CASE WHEN c_custkey % 211 = 0 THEN '1950-02-31' WHEN c_custkey % 223 = 0 THEN '' "
    "ELSE concat(2009 - (30 + c_custkey % 71), '-', lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0'), '-', "
    "lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0')) END",
    "DOD": "CASE WHEN c_custkey % 389 = 0 THEN 'unknown' WHEN c_custkey % 97 = 0 "
    "THEN CAST(DATE '1996-01-01' + CAST(c_custkey % 2000 AS INT) AS STRING) "
    "WHEN c_custkey % 307 = 0 THEN '1901-01-01' ELSE 'NA' END",
    "Gender": "CASE WHEN c_custkey % 83 = 0 THEN '3' WHEN c_custkey % 2 = 0 THEN '1' ELSE '2' END",
    "Race": "CAST(1 + c_custkey % 5 AS STRING)",
    "RenalDiseaseIndicator": "CASE WHEN c_custkey % 157 = 0 THEN 'X' WHEN c_custkey % 43 = 0 THEN '\"Y\"' "
    "WHEN c_custkey % 6 = 0 THEN 'Y' ELSE '0' END",
    "State": "CAST(1 + c_custkey % 55 AS STRING)",
    "County": "CAST(c_custkey % 200 * 10 AS STRING)",
    "NoOfMonths_PartACov": "'12'",
    "NoOfMonths_PartBCov": "CASE WHEN c_custkey % 3 = 0 THEN '6' ELSE '12' END",
    **{
        name: f"CASE {_SPECIAL_FLAGS.get(name, '')}WHEN c_custkey % {divisor} = 0 THEN '1' ELSE '2' END"
        for divisor, name in enumerate(CHRONIC_COLUMNS, 2)
    },
    "IPAnnualReimbursementAmt": "CAST(CAST(floor(greatest(c_acctbal, CAST(0 AS DOUBLE))) AS BIGINT) AS STRING)",
    "IPAnnualDeductibleAmt": "CASE WHEN c_custkey % 5 = 0 THEN '1068' ELSE '0' END",
    "OPAnnualReimbursementAmt": "CAST(c_custkey % 40 * 100 AS STRING)",
    "OPAnnualDeductibleAmt": "CASE WHEN c_custkey % 251 = 0 THEN 'abc' ELSE CAST(c_custkey % 7 * 10 AS STRING) END",
}
PROVIDER_RULES = {
    "Provider": "CASE WHEN s_suppkey % 9 = 4 THEN concat('PRV', s_suppkey, ' ') ELSE concat('PRV', s_suppkey) END",
    "PotentialFraud": "CASE WHEN s_suppkey % 17 = 5 THEN 'Maybe' WHEN s_suppkey % 10 = 0 THEN 'Yes' "
    "WHEN s_suppkey % 4 = 1 THEN ' No' ELSE 'No' END",
}


def _apply(df: DataFrame, rules: dict[str, str], names: list[str]) -> DataFrame:
    return df.selectExpr(*[f"{rules[name]} AS {name}" for name in names])


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw datasets, all columns text, stray quotes still in place."""
    lines = order_lines(spark, sf_dir)
    base = lines.selectExpr("*", *[f"{rule} AS {name}" for name, rule in BASE_RULES.items()])
    return {
        "provider": _apply(
            table(spark, sf_dir, "supplier"), PROVIDER_RULES, RAW_COLUMNS["provider"]
        ),
        "inpatient": _apply(base.filter("inpatient"), CLAIM_RULES, RAW_COLUMNS["inpatient"]),
        "outpatient": _apply(base.filter("not inpatient"), CLAIM_RULES, RAW_COLUMNS["outpatient"]),
        "beneficiary": _apply(
            table(spark, sf_dir, "customer"), BENEFICIARY_RULES, RAW_COLUMNS["beneficiary"]
        ),
    }
