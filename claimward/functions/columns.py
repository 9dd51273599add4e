"""Reusable column expressions. Everything here stays inside generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql.window import Window

INPATIENT = "Inpatient"
OUTPATIENT = "Outpatient"


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def mean(value: str | Column) -> Column:
    """Average of whole numbers as exact sum over exact count.

    The built-in average adds up doubles, which loses digits once sums pass 2^53 and
    then depends on the order in which partial results arrive.
    """
    return F.try_divide(F.sum(col(value)), F.count(col(value)))


def ratio(part: str | Column, whole: str | Column) -> Column:
    """Double quotient, NULL when the divisor is zero or NULL."""
    return F.try_divide(col(part).cast("double"), col(whole).cast("double"))


def percent(part: str | Column, whole: str | Column) -> Column:
    return ratio(part, whole) * 100


def ratio_or_zero(part: str | Column, whole: str | Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def share(value: str | Column, *within: str) -> Column:
    """Percentage of the total of ``value`` over the given columns (all rows if none).

    Only for results whose row count is bounded by a dimension (states, months, tiers).
    """
    window = Window.partitionBy(*within)
    return percent(value, F.sum(col(value)).over(window))


def relative(value: str | Column, base: str | Column) -> Column:
    """Difference from ``base`` in percent of ``base``."""
    return F.try_divide(col(value) - col(base), col(base)) * 100


def whole_div(part: str | Column, whole: str | Column) -> Column:
    """Integer division, NULL for a zero divisor."""
    return F.call_function("div", col(part), F.nullif(col(whole), F.lit(0).cast("bigint")))


def steps(value: str | Column, ladder: list[tuple[float, object]], otherwise: object) -> Column:
    """First label whose bound lies strictly below ``value``."""
    branches = [(col(value) > bound, label) for bound, label in ladder]
    return choose(branches, otherwise)


def choose(branches: list[tuple[Column, object]], otherwise: object) -> Column:
    head, *tail = branches
    start = F.when(head[0], head[1])
    return reduce(lambda acc, item: acc.when(item[0], item[1]), tail, start).otherwise(otherwise)


def is_inpatient() -> Column:
    return F.col("claim_type") == INPATIENT


def is_outpatient() -> Column:
    return F.col("claim_type") == OUTPATIENT


def amount_when(condition: Column, amount: str = "claim_reimbursement_amt") -> Column:
    """Sum of the amount over matching rows, zero when there is none."""
    return F.coalesce(F.sum(F.when(condition, F.col(amount))), F.lit(0).cast("bigint"))


def same_day() -> Column:
    """Same-day flag with NULL (outpatient) read as false."""
    return F.coalesce(F.col("is_same_day_discharge"), F.lit(False))


# --- text cleaning -------------------------------------------------------------------


def text_or_null(name: str, placeholder: str = "NA") -> Column:
    """Trimmed text with the missing-value placeholder read as NULL; blanks stay."""
    return F.expr(f"nullif(trim({name}), '{placeholder}')")


def number_or_zero(name: str, kind: str, placeholder: str = "NA") -> Column:
    """Typed number where the placeholder stands for zero and junk for NULL."""
    cleaned = F.trim(F.col(name))
    return F.when(cleaned == placeholder, F.lit(0).cast(kind)).otherwise(cleaned.try_cast(kind))


def is_blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(F.col(name)) == "")


def filled_count(names: list[str], placeholder: str = "NA") -> Column:
    """How many of the given slots hold a real code.

    One SQL expression of plain conditionals, which compiles into the scan stage; a
    higher-order function over an array would be interpreted row by row.
    """
    slot = "if(coalesce(trim({0}) not in ('" + placeholder + "', ''), false), 1, 0)"
    return F.expr(" + ".join(slot.format(name) for name in names))


# --- calendar ------------------------------------------------------------------------


def year_gap(start: str | Column, end: str | Column) -> Column:
    """Calendar years crossed, not completed years."""
    return F.year(col(end)) - F.year(col(start))


def month_gap(start: str | Column, end: str | Column) -> Column:
    """Calendar months crossed."""
    return year_gap(start, end) * 12 + F.month(col(end)) - F.month(col(start))


def week_from_sunday(day: str | Column) -> Column:
    """Week number where week 1 holds January 1st and weeks start on Sunday."""
    day = col(day)
    lead = F.dayofweek(F.trunc(day, "year"))
    return F.floor((F.dayofyear(day) + lead - 2) / 7).cast("int") + 1


def date_key(day: str | Column) -> Column:
    return F.date_format(col(day), "yyyyMMdd").cast("int")


def age_tier(age: str | Column) -> Column:
    """Four age tiers; an unknown age falls into the last."""
    age = col(age)
    return choose([(age < 45, "Below 45"), (age < 55, "45-54"), (age < 65, "55-64")], "65+")
