"""Claims-shaped view of the given star tables (typed, for the business queries).

Whole-number arithmetic only, so that any SQL engine reproduces the values exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimward.config import CONDITION_FLAGS
from claimward.functions.columns import age_tier, date_key
from claimward.model import ClaimsModel


# Declared column types of the given tables: no file is opened to find out a schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_FLAGS = [
    f"cast(c_custkey % {divisor} = 0 as int) as {flag}"
    for divisor, flag in enumerate(CONDITION_FLAGS, 2)
]


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as provider_key",
        "s_suppkey as provider_id",
        "s_suppkey % 10 = 0 as is_potential_fraud",
        "if(s_suppkey % 10 = 0, 'Fraud', 'Not Fraud') as fraud_label",
    )


def beneficiaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as beneficiary_key",
        "c_custkey as beneficiary_id",
        "cast(30 + c_custkey % 71 as int) as patient_age",
        "if(c_custkey % 2 = 0, 'Male', 'Female') as gender",
        "c_nationkey as state_code",
        "c_custkey % 97 = 0 as is_deceased",
        "if(c_custkey % 97 = 0, date_add(date '1996-01-01', cast(c_custkey % 2000 as int)), null)"
        " as date_of_death",
        "cast(floor(greatest(c_acctbal, 0d)) as bigint) as ip_annual_reimbursement_amt",
        "c_custkey % 40 * 100 as op_annual_reimbursement_amt",
        *_FLAGS,
    )
    return base.selectExpr(
        "*",
        "make_date(2009 - patient_age, cast(1 + beneficiary_key % 12 as int), "
        "cast(1 + beneficiary_key % 28 as int)) as date_of_birth",
        " + ".join(CONDITION_FLAGS) + " as chronic_condition_count",
    ).withColumn("age_group", age_tier("patient_age"))


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey as geo_key",
        "n_nationkey as state_code",
        "n_name as state_name",
        "concat('N', n_nationkey) as state_abbr",
        "r_name as region",
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, as the tables hold them.

    Both sides grow with the claims, so they meet by their key; every derived column is
    computed behind that shuffle, over its partitions, and only stored columns are moved.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)


def claim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as claims."""
    base = order_lines(spark, sf_dir).selectExpr(
        "*",
        "l_returnflag = 'R' and l_partkey % 4 = 0 as inpatient",
        "if(l_partkey % 27 = 0, 0L, cast(floor(l_extendedprice / 10) as bigint) * "
        "case l_suppkey % 20 when 3 then 5 when 0 then 3 when 7 then 2 else 1 end) as amount",
        "if(l_suppkey % 5 = 1 and l_linenumber = 1, 0, cast(l_quantity as int) % 36) as days",
    )
    return base.selectExpr(
        "o_custkey as beneficiary_key",
        "cast(o_orderdate as date) as claim_start_date",
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        "cast(round(l_extendedprice * 100) as bigint)) as claim_id",
        "l_suppkey as provider_key",
        "l_suppkey % 10 = 0 as is_potential_fraud",
        "if(inpatient, 'Inpatient', 'Outpatient') as claim_type",
        "amount as claim_reimbursement_amt",
        "cast(cast(round(l_tax * 100) as int) as decimal(10,2)) as deductible_amt_paid",
        "if(l_partkey % 11 <> 0, l_partkey % 50, null) as attending_physician_id",
        "days as claim_duration_days",
        "if(inpatient, days, null) as admission_duration_days",
        "cast(if(l_suppkey % 7 = 0, 9 + l_partkey % 2, 1 + l_partkey % 9) as int)"
        " as diagnosis_code_count",
        "cast(l_partkey % 4 as int) as procedure_code_count",
        "amount = 0 as is_zero_reimbursement",
        "if(inpatient, days = 0, null) as is_same_day_discharge",
    )


def model(spark: SparkSession, sf_dir: str) -> ClaimsModel:
    """Lines with their order are the fact; dimensions are joined by the queries."""
    fact = claim_lines(spark, sf_dir).withColumn("claim_start_date_key", date_key("claim_start_date"))
    return ClaimsModel(
        fact,
        providers(spark, sf_dir),
        beneficiaries(spark, sf_dir),
        geography(spark, sf_dir),
    )
