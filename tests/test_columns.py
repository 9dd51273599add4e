import pytest
from conftest import day
from pyspark.sql import functions as F

from claimward.functions import columns as C
from claimward.sources import lookups


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("y")).collect()[0].y


@pytest.mark.parametrize(
    "text, week",
    [("2008-12-31", 53), ("2009-01-01", 1), ("2009-01-03", 1), ("2009-01-04", 2), ("2008-11-01", 44)],
)
def test_week_starts_on_sunday_and_holds_january_first(spark, text, week):
    assert one(spark, C.week_from_sunday("d"), "d date", (day(text),)) == week


def test_gaps_count_boundaries_not_completed_units(spark):
    row = (day("2008-12-31"), day("2009-01-01"))
    assert one(spark, C.year_gap("a", "b"), "a date, b date", row) == 1
    assert one(spark, C.month_gap("a", "b"), "a date, b date", row) == 1


def test_division_by_zero_is_null_or_zero(spark):
    assert one(spark, C.ratio("x", F.lit(0))) is None
    assert one(spark, C.ratio_or_zero("x", F.lit(0))) == 0.0
    assert one(spark, C.whole_div(F.lit(7), F.lit(2))) == 3
    assert one(spark, C.whole_div(F.lit(7), F.lit(0))) is None


def test_steps_need_more_than_the_bound(spark):
    ladder = [(10, 3), (5, 2), (0, 1)]
    df = spark.createDataFrame([(v,) for v in (11, 10, 6, 5, 1, 0, None)], "v int")
    got = [r.s for r in df.select(C.steps("v", ladder, 0).alias("s")).collect()]
    assert got == [3, 2, 2, 1, 1, 0, 0]


def test_filled_slots_ignore_placeholder_blank_and_null(spark):
    row = ("D1", " NA ", "", None, "  ", "D2")
    assert one(spark, C.filled_count(list("abcdef")), ", ".join(f"{c} string" for c in "abcdef"), row) == 2


def test_mean_is_exact_where_doubles_are_not(spark):
    big = 2**53
    df = spark.createDataFrame([(big,), (1,), (1,)], "v bigint")
    assert df.agg(C.mean("v").alias("m")).collect()[0].m == (big + 2) / 3


def test_calendar_of_the_public_period(spark):
    days = lookups.calendar(spark)
    assert days.count() == 426
    row = days.filter("date_key = 20081101").collect()[0]
    assert (row.day_name, row.month_name, row.quarter_name, row.year_month, row.is_weekend) == (
        "Saturday", "November", "Q4", "2008-11", True,
    )


def test_states_and_series(spark):
    rows = lookups.states(spark).collect()
    assert len(rows) == 52 and len({r.state_code for r in rows}) == 52
    assert not {40, 48} & {r.state_code for r in rows}
    assert [r.cap_amount for r in lookups.parameter_series(spark, "cap_amount").collect()] == list(
        range(5000, 50001, 5000)
    )
    assert lookups.parameter_series(spark, "care_manager_capacity").count() == 40
    assert lookups.conditions(spark).count() == 11
    assert lookups.metric_names(spark).count() == 6
