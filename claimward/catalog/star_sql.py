"""SQL twin of the claims-shaped view, for the side-by-side check in DuckDB."""

from claimward.config import CONDITIONS

_flags = ",\n    ".join(
    f"CAST(c_custkey % {divisor} = 0 AS INTEGER) AS {row[0]}"
    for divisor, row in enumerate(CONDITIONS, 2)
)
_count = " + ".join(row[0] for row in CONDITIONS)

STAR = f"""
WITH provider AS (
  SELECT s_suppkey AS provider_key, s_suppkey AS provider_id,
    s_suppkey % 10 = 0 AS is_potential_fraud,
    CASE WHEN s_suppkey % 10 = 0 THEN 'Fraud' ELSE 'Not Fraud' END AS fraud_label
  FROM supplier),
beneficiary0 AS (
  SELECT c_custkey AS beneficiary_key, c_custkey AS beneficiary_id,
    make_date(CAST(2009 - (30 + c_custkey % 71) AS INTEGER), CAST(1 + c_custkey % 12 AS INTEGER),
              CAST(1 + c_custkey % 28 AS INTEGER)) AS date_of_birth,
    CASE WHEN c_custkey % 97 = 0
         THEN date '1996-01-01' + CAST(c_custkey % 2000 AS INTEGER) END AS date_of_death,
    CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    c_nationkey AS state_code,
    CAST(30 + c_custkey % 71 AS INTEGER) AS patient_age,
    CASE WHEN 30 + c_custkey % 71 < 45 THEN 'Below 45' WHEN 30 + c_custkey % 71 < 55 THEN '45-54'
         WHEN 30 + c_custkey % 71 < 65 THEN '55-64' ELSE '65+' END AS age_group,
    c_custkey % 97 = 0 AS is_deceased,
    {_flags},
    CAST(floor(greatest(c_acctbal, 0)) AS BIGINT) AS ip_annual_reimbursement_amt,
    c_custkey % 40 * 100 AS op_annual_reimbursement_amt
  FROM customer),
beneficiary AS (SELECT *, {_count} AS chronic_condition_count FROM beneficiary0),
geo AS (
  SELECT n_nationkey AS geo_key, n_nationkey AS state_code, n_name AS state_name,
    'N' || n_nationkey AS state_abbr, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
line AS (
  SELECT *, l_returnflag = 'R' AND l_partkey % 4 = 0 AS inpatient,
    CASE WHEN l_partkey % 27 = 0 THEN 0 ELSE CAST(floor(l_extendedprice / 10) AS BIGINT) *
      CASE WHEN l_suppkey % 20 = 3 THEN 5 WHEN l_suppkey % 20 = 0 THEN 3
           WHEN l_suppkey % 20 = 7 THEN 2 ELSE 1 END END AS amount,
    CASE WHEN l_suppkey % 5 = 1 AND l_linenumber = 1 THEN 0
         ELSE CAST(l_quantity AS INTEGER) % 36 END AS days
  FROM lineitem),
c AS (
  SELECT p.*, b.*, g.geo_key, g.state_name, g.state_abbr, g.region,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CAST(round(l_extendedprice * 100) AS BIGINT)) AS claim_id,
    CASE WHEN inpatient THEN 'Inpatient' ELSE 'Outpatient' END AS claim_type,
    CAST(o_orderdate AS DATE) AS claim_start_date,
    CAST(year(o_orderdate) AS INTEGER) AS year_num, CAST(month(o_orderdate) AS INTEGER) AS month_num,
    monthname(o_orderdate) AS month_name, strftime(o_orderdate, '%Y-%m') AS year_month,
    amount AS claim_reimbursement_amt,
    CAST(CAST(round(l_tax * 100) AS INTEGER) AS DECIMAL(10,2)) AS deductible_amt_paid,
    CASE WHEN l_partkey % 11 <> 0 THEN l_partkey % 50 END AS attending_physician_id,
    days AS claim_duration_days,
    CASE WHEN inpatient THEN days END AS admission_duration_days,
    CAST(CASE WHEN l_suppkey % 7 = 0 THEN 9 + l_partkey % 2 ELSE 1 + l_partkey % 9 END AS INTEGER)
      AS diagnosis_code_count,
    CAST(l_partkey % 4 AS INTEGER) AS procedure_code_count,
    amount = 0 AS is_zero_reimbursement,
    CASE WHEN inpatient THEN days = 0 END AS is_same_day_discharge
  FROM line JOIN orders ON l_orderkey = o_orderkey
  JOIN provider p ON p.provider_key = l_suppkey
  JOIN beneficiary b ON b.beneficiary_key = o_custkey
  LEFT JOIN geo g ON g.state_code = b.state_code)
"""

# Twins of the average and rounding rules.
def mean(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)"


def total(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def total_if(x: str, cond: str) -> str:
    return f"CAST(coalesce(sum({x}) FILTER (WHERE {cond}), 0) AS BIGINT)"


def rows_if(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def rounded(numerator: str, denominator: str) -> str:
    """Quotient of whole numbers rounded half away from zero to two places."""
    return (
        f"CASE WHEN {denominator} > 0 THEN CAST(sign({numerator}) * "
        f"((200 * abs(CAST({numerator} AS HUGEINT)) + {denominator}) // (2 * {denominator})) AS DOUBLE) / 100 END"
    )


def mean2(x: str) -> str:
    return rounded(f"sum({x})", f"count({x})")
