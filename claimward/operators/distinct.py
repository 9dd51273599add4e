"""Distinct counts that add up over months and states.

A distinct count of one month cannot be added to that of the next. The sets can: keys are
dense numbers, so the set of a state and month is a few bitmaps of 32,768 keys each. They
are stored with the rollups. A question about any months and states merges bitmaps bit by
bit and counts what is set, exactly, without a look at the claims.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimward.functions.columns import ratio_or_zero
from claimward.model import MONTH_KEY, ClaimsModel, name_months, with_month
from claimward.operators.gold import mapped_state, state_month_rollup
from claimward.operators.metrics import Filters, filtered

#: Stored sets and the key a claim adds to each; a missing key adds none.
SETS: dict[str, str] = {
    "unique_providers": "provider_key",
    "fraud_providers": "if(is_potential_fraud, provider_key, null)",
    "unique_beneficiaries": "beneficiary_key",
}
STATE_KEY = ["state_code", "state_name", "state_abbr", "region"]
GRAIN = [*STATE_KEY, *MONTH_KEY]
KEY_ROLLUP = "agg_state_monthly_keys"


def key_bitmaps(rows: DataFrame, by: list[str], sets: dict[str, str]) -> DataFrame:
    """One bitmap per group, set and bucket of keys.

    A bitmap has 4 KB however few keys it holds, so it is made only where all of its keys are:
    what is moved first are pairs of a group and a key, by group, set and bucket. Otherwise a task
    whose rows are in no order would hand on a bitmap for nearly every row. Adaptive execution
    splits the rows of a hot group, which then has one bitmap per bucket and slice to merge. Keys
    must be positive; the denser they are, the fewer bitmaps.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(place).cast("tinyint").alias("set_no"), F.expr(key).cast("bigint").alias("key"))
            for place, key in enumerate(sets.values())
        ]
    )
    places = rows.select(*by, F.inline(pairs)).filter(F.col("key").isNotNull()).select(
        *by,
        "set_no",
        F.bitmap_bucket_number("key").alias("bucket"),
        F.bitmap_bit_position("key").cast("smallint").alias("place"),
    )
    # by a hash of the columns: by the columns themselves the rows would count as gathered for
    # the aggregate, and a hot group could not be split
    made = (
        places.withColumn("slot", F.hash(*by, "set_no", "bucket"))
        .hint("rebalance", "slot")
        .groupBy(*by, "set_no", "bucket")
        .agg(F.bitmap_construct_agg(F.col("place").cast("bigint")).alias("keys"))
    )
    names = F.array(*[F.lit(name) for name in sets])
    return made.select(*by, names[F.col("set_no")].alias("set_name"), "bucket", "keys")


def distinct_counts(bitmaps: DataFrame, by: list[str], sets: dict[str, str]) -> DataFrame:
    """Distinct keys of every set per coarser group ``by``, one column per set."""
    merged = bitmaps.groupBy(*by, "set_name", "bucket").agg(F.bitmap_or_agg("keys").alias("keys"))
    size = F.bitmap_count("keys")

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("set_name") == name, size)), F.lit(0).cast("bigint"))

    return merged.groupBy(*by).agg(*[of(name).alias(name) for name in sets])


def with_counts(sums: DataFrame, counted: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Rows of sums with the distinct counts of the same groups; a missing key is a group too."""
    if by:
        same = [sums[c].eqNullSafe(counted[c]) for c in by]
        return sums.join(counted, same, "left").select(*[sums[c] for c in sums.columns], *names)
    zero = F.lit(0).cast("bigint")
    return sums.withColumn("sizes", counted.select(F.struct(*names)).scalar()).select(
        *sums.columns, *[F.coalesce(F.col("sizes")[name], zero).alias(name) for name in names]
    )


def state_month_keys(model: ClaimsModel) -> DataFrame:
    """The sets of every state and month, beside the rollup of the same grain."""
    placed = with_month(model.joined("beneficiary", "state").withColumns(mapped_state()))
    return key_bitmaps(placed, GRAIN, SETS)


def in_months(rows: DataFrame, months: tuple[int, int] | None) -> DataFrame:
    """Rows from the first to the last month, both given as yyyymm and included."""
    if not months:
        return rows
    return rows.filter((F.col("year_num") * 100 + F.col("month_num")).between(*months))


def range_metrics(
    model: ClaimsModel,
    by: list[str] | None = None,
    filters: Filters | None = None,
    months: tuple[int, int] | None = None,
) -> DataFrame:
    """Claims, amounts and distinct counts per group, for any states and months.

    Read from the stored rollup and its sets where the model has them, else both are made
    from the claims first. ``by`` and ``filters`` name columns of the rollup's grain.
    """
    by = by or []
    unknown = {*by, *(filters or {})} - set(GRAIN)
    if unknown:
        raise KeyError(f"not in the grain of the rollup: {sorted(unknown)}")
    sums = model.rollups.get("agg_state_monthly")
    keys = model.rollups.get(KEY_ROLLUP)
    sums = state_month_rollup(model) if sums is None else sums
    keys = state_month_keys(model) if keys is None else keys
    added = (
        in_months(filtered(sums, filters), months)
        .groupBy(*by)
        .agg(
            F.coalesce(F.sum("total_claims"), F.lit(0).cast("bigint")).alias("total_claims"),
            F.coalesce(F.sum("total_reimbursement"), F.lit(0).cast("bigint")).alias("total_reimbursement"),
        )
    )
    counted = distinct_counts(in_months(filtered(keys, filters), months), by, SETS)
    both = with_counts(added, counted, by, list(SETS))
    return both.withColumns(
        {
            "fraud_rate": ratio_or_zero(F.col("fraud_providers"), F.col("unique_providers")),
            "avg_reimbursement_per_beneficiary": ratio_or_zero(
                F.col("total_reimbursement"), F.col("unique_beneficiaries")
            ),
        }
    )


def rolling_distinct(model: ClaimsModel, months: int = 3, by: list[str] | None = None) -> DataFrame:
    """Distinct counts over a window of calendar months that ends in each month.

    Every stored bitmap counts for its own month and the next ``months - 1``; only windows
    that end in a month of the data are kept. Exact, where counts per month cannot be added.
    """
    by = by or []
    keys = model.rollups.get(KEY_ROLLUP)
    keys = state_month_keys(model) if keys is None else keys
    number = F.col("year_num") * 12 + F.col("month_num") - 1
    numbered = keys.withColumn("month_no", number)
    ends = numbered.select("month_no").distinct()
    ahead = F.explode(F.sequence(F.col("month_no"), F.col("month_no") + months - 1))
    spread = (
        numbered.select(*by, "set_name", "bucket", "keys", ahead.alias("end_no"))
        .join(ends.withColumnRenamed("month_no", "end_no"), "end_no", "left_semi")
    )
    counted = distinct_counts(spread, [*by, "end_no"], SETS)
    return name_months(
        counted.withColumns(
            {
                "year_num": F.floor(F.col("end_no") / 12).cast("int"),
                "month_num": (F.col("end_no") % 12 + 1).cast("int"),
            }
        ).drop("end_no")
    )
