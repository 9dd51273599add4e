"""Reference rows: states, calendar, parameter series, names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimward.config import CALENDAR_END, CALENDAR_START, CONDITIONS
from claimward.functions.columns import date_key, week_from_sunday
from claimward.operators.metrics import SWITCH

# State codes of the claims data, codes 40 and 48 are not assigned.
STATES = """
1 Alabama AL South
2 Alaska AK West
3 Arizona AZ West
4 Arkansas AR South
5 California CA West
6 Colorado CO West
7 Connecticut CT Northeast
8 Delaware DE South
9 District of Columbia DC South
10 Florida FL South
11 Georgia GA South
12 Hawaii HI West
13 Idaho ID West
14 Illinois IL Midwest
15 Indiana IN Midwest
16 Iowa IA Midwest
17 Kansas KS Midwest
18 Kentucky KY South
19 Louisiana LA South
20 Maine ME Northeast
21 Maryland MD South
22 Massachusetts MA Northeast
23 Michigan MI Midwest
24 Minnesota MN Midwest
25 Mississippi MS South
26 Missouri MO Midwest
27 Montana MT West
28 Nebraska NE Midwest
29 Nevada NV West
30 New Hampshire NH Northeast
31 New Jersey NJ Northeast
32 New Mexico NM West
33 New York NY Northeast
34 North Carolina NC South
35 North Dakota ND Midwest
36 Ohio OH Midwest
37 Oklahoma OK South
38 Oregon OR West
39 Pennsylvania PA Northeast
41 Rhode Island RI Northeast
42 South Carolina SC South
43 South Dakota SD Midwest
44 Tennessee TN South
45 Texas TX South
46 Utah UT West
47 Vermont VT Northeast
49 Virginia VA South
50 Washington WA West
51 West Virginia WV South
52 Wisconsin WI Midwest
53 Wyoming WY West
54 Other/Unknown XX Unknown
"""

# First value, last value and step of each parameter series.
SERIES = {
    "cap_amount": (5000, 50000, 5000),
    "care_manager_capacity": (500, 20000, 500),
    "risk_threshold": (1, 15, 1),
    "top_n": (1, 50, 1),
}


def state_rows() -> list[tuple[int, str, str, str]]:
    rows = []
    for line in STATES.strip().splitlines():
        code, *name, abbr, region = line.split()
        rows.append((int(code), " ".join(name), abbr, region))
    return rows


def states(spark: SparkSession) -> DataFrame:
    """52 literal rows, so small enough to broadcast at any scale."""
    rows = [(place, *row) for place, row in enumerate(state_rows(), 1)]
    return F.broadcast(
        spark.createDataFrame(
            rows, "geo_key bigint, state_code int, state_name string, state_abbr string, region string"
        )
    )


def calendar_columns(day: Column) -> dict[str, Column]:
    return {
        "date_key": date_key(day),
        "full_date": day,
        "day_of_month": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEEE"),
        "week_of_year": week_from_sunday(day),
        "month_num": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter_num": F.quarter(day),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "year_num": F.year(day),
        "year_month": F.date_format(day, "yyyy-MM"),
        "is_weekend": F.dayofweek(day).isin(1, 7),
    }


def describe_days(df: DataFrame, day: str) -> DataFrame:
    """Twelve calendar attributes for a column of days."""
    return df.select(*[expr.alias(name) for name, expr in calendar_columns(F.col(day)).items()])


def calendar(
    spark: SparkSession, start: str | dt.date = CALENDAR_START, end: str | dt.date = CALENDAR_END
) -> DataFrame:
    """One row per day from start to end, both included."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
        ).alias("day")
    )
    return describe_days(days, "day")


def calendar_over(claims: DataFrame, day: str = "claim_start_date") -> DataFrame:
    """The calendar from the first to the last day of the claims."""
    days = claims.agg(F.min(day).alias("first"), F.max(day).alias("last")).select(
        F.explode(F.sequence("first", "last")).alias("day")
    )
    return describe_days(days, "day")


def parameter_series(spark: SparkSession, name: str) -> DataFrame:
    first, last, step = SERIES[name]
    return spark.range(first, last + 1, step).select(F.col("id").alias(name))


def conditions(spark: SparkSession) -> DataFrame:
    rows = [(place, row[2], row[0]) for place, row in enumerate(CONDITIONS, 1)]
    return spark.createDataFrame(rows, "sort_order int, disease_name string, flag_column string")


def metric_names(spark: SparkSession) -> DataFrame:
    rows = [(place, label) for place, label in enumerate(SWITCH, 1)]
    return spark.createDataFrame(rows, "sort_order int, metric_name string")
