"""Read-only reports on raw text data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from claimward.config import AGE_REFERENCE_DATE
from claimward.functions.columns import (
    filled_count,
    is_blank,
    mean,
    month_gap,
    percent,
    year_gap,
)
from claimward.operators.tally import measured, named_count, orphan_rows, union_all
from claimward.schemas import (
    DATASETS,
    DIAGNOSIS_COLUMNS,
    PRIMARY_KEYS,
    PROCEDURE_COLUMNS,
    RAW_COLUMNS,
)

Raw = dict[str, DataFrame]
NAMES = {
    "provider": "raw_provider",
    "inpatient": "raw_inpatient",
    "outpatient": "raw_outpatient",
    "beneficiary": "raw_beneficiary",
}


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def as_date(name: str) -> Column:
    return F.expr(f"try_cast(trim({name}) as date)")


def as_int(name: str) -> Column:
    return F.expr(f"try_cast(trim({name}) as int)")


def as_number(name: str) -> Column:
    return F.expr(f"try_cast(trim({name}) as double)")


def _rows() -> Column:
    return F.count(F.lit(1))


# --- column profile ------------------------------------------------------------------


def values_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column and distinct value with its count.

    Equal values are counted inside each task before anything is shuffled, and the shuffle
    key contains the value, so neither a frequent value nor a wide column is a hot spot.
    """
    return (
        df.select(*columns)
        .unpivot([], columns, "column_name", "value")
        .groupBy("column_name", "value")
        .agg(_rows().alias("n"))
    )


def columns_profile(df: DataFrame, dataset: str, top: int = 5) -> DataFrame:
    """Null, blank, NA and distinct counts and the most frequent values of every column."""
    long = values_long(df, RAW_COLUMNS[dataset])
    zero = F.lit(0).cast("bigint")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), zero)

    value = F.col("value")
    stats = long.groupBy("column_name").agg(
        rows_where(value.isNull()).alias("null_count"),
        rows_where(value == "").alias("blank_count"),
        rows_where(value == "NA").alias("na_count"),
        F.count(value).alias("distinct_count"),
    )
    # The filter on the place is applied inside each task first, so only a handful of
    # candidates per column and task are shuffled. NULL sorts last and goes afterwards:
    # both branches then read the same counted values, which are shuffled once.
    order = Window.partitionBy("column_name").orderBy(
        value.isNull(), F.desc("n"), F.asc_nulls_last("value")
    )
    frequent = (
        long.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= top)
        .filter(value.isNotNull())
        .groupBy("column_name")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("place", F.concat_ws("=", value, F.col("n").cast("string")).alias("t"))
                )
            ).alias("best")
        )
    )
    text = F.concat_ws("; ", F.transform("best", lambda item: item["t"]))
    return (
        stats.join(frequent, "column_name", "left")
        .withColumn("top_values", text)
        .withColumn("dataset", F.lit(dataset))
        .drop("best")
    )


def rows_per_key(df: DataFrame, dataset: str) -> DataFrame:
    """Rows ``n`` of every key; a missing key counts as a blank one."""
    key = [F.coalesce(F.col(name), F.lit("")).alias(name) for name in PRIMARY_KEYS[dataset]]
    return df.groupBy(*key).agg(_rows().alias("n"))


def dataset_profile(df: DataFrame, dataset: str, expected: int | None) -> DataFrame:
    """Rows against expectation, number of columns, surplus rows of the key."""
    counted = rows_per_key(df, dataset).agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("row_count"), _rows().alias("keys")
    )
    return counted.select(
        F.lit(dataset).alias("dataset"),
        "row_count",
        F.lit(expected).cast("bigint").alias("expected_rows"),
        (F.col("row_count") == F.lit(expected).cast("bigint")).alias("row_count_match"),
        F.lit(len(RAW_COLUMNS[dataset])).alias("column_count"),
        (F.col("row_count") - F.col("keys")).alias("pk_duplicates"),
    )


def profile_all(raw: Raw, expected: dict[str, int]) -> DataFrame:
    return union_all([dataset_profile(raw[n], n, expected.get(n)) for n in DATASETS])


def profile_all_columns(raw: Raw) -> DataFrame:
    return union_all([columns_profile(raw[n], n) for n in DATASETS])


# --- keys ----------------------------------------------------------------------------


def null_keys(raw: Raw) -> DataFrame:
    """Missing (NULL or blank) join keys."""
    keys = {
        "provider": ["Provider"],
        "inpatient": ["BeneID", "ClaimID", "Provider"],
        "outpatient": ["BeneID", "ClaimID", "Provider"],
        "beneficiary": ["BeneID"],
    }
    return union_all(
        [
            measured(
                raw[dataset],
                [
                    (f"{NAMES[dataset]}.{name}", {"null_count": F.count_if(is_blank(name))})
                    for name in names
                ],
                "check_name",
            )
            for dataset, names in keys.items()
        ]
    )


def duplicate_groups(raw: Raw) -> DataFrame:
    """Keys that occur more than once."""

    def groups(dataset: str) -> DataFrame:
        (key,) = PRIMARY_KEYS[dataset]
        repeated = raw[dataset].groupBy(key).agg(_rows().alias("n")).filter("n > 1")
        return repeated.agg(
            F.lit(f"{NAMES[dataset]}.{key}").alias("check_name"), _rows().alias("duplicate_groups")
        )

    return union_all([groups(dataset) for dataset in DATASETS])


def overlap(raw: Raw) -> DataFrame:
    """Claim ids found in both claim files."""
    both = raw["inpatient"].select("ClaimID").intersect(raw["outpatient"].select("ClaimID"))
    return both.agg(_rows().alias("claim_ids_in_both"))


def orphans(raw: Raw) -> DataFrame:
    """Claims without a beneficiary or provider row."""
    parents = {"BeneID": raw["beneficiary"], "Provider": raw["provider"]}
    return union_all(
        [
            named_count(
                orphan_rows(
                    raw[dataset].withColumn(key, trimmed(key)),
                    key,
                    parent.withColumn(key, trimmed(key)),
                    key,
                ),
                f"{NAMES[dataset]}.{key} without parent",
            )
            for dataset in ("inpatient", "outpatient")
            for key, parent in parents.items()
        ]
    )


# --- values --------------------------------------------------------------------------


def _bad_date(name: str) -> Column:
    """A filled field that is no date; the placeholder is no date either."""
    return ~is_blank(name) & as_date(name).isNull()


def _counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    return measured(
        df, [(name, {"issue_count": F.count_if(bad)}) for name, bad in checks.items()], "check_name"
    )


def dates(raw: Raw) -> DataFrame:
    """Unparseable dates and ends before starts."""
    inpatient = {
        f"Inpatient: {name} not a valid date": _bad_date(name)
        for name in ("ClaimStartDt", "ClaimEndDt", "AdmissionDt", "DischargeDt")
    }
    inpatient["Inpatient: ClaimEndDt before ClaimStartDt"] = as_date("ClaimEndDt") < as_date(
        "ClaimStartDt"
    )
    inpatient["Inpatient: DischargeDt before AdmissionDt"] = as_date("DischargeDt") < as_date(
        "AdmissionDt"
    )
    outpatient = {
        "Outpatient: ClaimStartDt not a valid date": _bad_date("ClaimStartDt"),
        "Outpatient: ClaimEndDt before ClaimStartDt": as_date("ClaimEndDt")
        < as_date("ClaimStartDt"),
    }
    beneficiary = {
        "Beneficiary: DOB not a valid date": _bad_date("DOB"),
        "Beneficiary: DOD not a valid date": _bad_date("DOD") & (trimmed("DOD") != "NA"),
        "Beneficiary: DOD before DOB": as_date("DOD") < as_date("DOB"),
    }
    return union_all(
        [
            _counts(raw["inpatient"], inpatient),
            _counts(raw["outpatient"], outpatient),
            _counts(raw["beneficiary"], beneficiary),
        ]
    )


def numbers(raw: Raw) -> DataFrame:
    """Amounts that are no numbers or not positive, codes outside their domain."""
    amount = as_int("InscClaimAmtReimbursed")
    deductible = trimmed("DeductibleAmtPaid")
    amounts = {
        "InscClaimAmtReimbursed not numeric": amount.isNull(),
        "InscClaimAmtReimbursed negative or zero": amount <= 0,
    }
    beneficiary = measured(
        raw["beneficiary"],
        [
            ("Beneficiary: Gender values present", {"issue_count": F.count_distinct("Gender")}),
            (
                "Beneficiary: Chronic flag values outside 1/2",
                {"issue_count": F.count_if(~trimmed("ChronicCond_Alzheimer").isin("1", "2"))},
            ),
        ],
        "check_name",
    )
    return union_all(
        [
            _counts(
                raw["inpatient"],
                {
                    **{f"Inpatient: {name}": bad for name, bad in amounts.items()},
                    "Inpatient: DeductibleAmtPaid not numeric": (deductible != "NA")
                    & as_number("DeductibleAmtPaid").isNull(),
                },
            ),
            _counts(
                raw["outpatient"], {f"Outpatient: {name}": bad for name, bad in amounts.items()}
            ),
            beneficiary,
        ]
    )


def domains(raw: Raw) -> DataFrame:
    """Distinct values of the three coded columns."""
    coded = {
        "PotentialFraud": raw["provider"],
        "Gender": raw["beneficiary"],
        "RenalDiseaseIndicator": raw["beneficiary"],
    }
    return union_all(
        [
            df.select(F.lit(name).alias("column_name"), F.col(name).alias("value")).distinct()
            for name, df in coded.items()
        ]
    )


def na_rates(raw: Raw) -> DataFrame:
    """How often the placeholder stands in four columns."""

    def rates(dataset: str, label: str, names: list[str]) -> DataFrame:
        rows = []
        for name in names:
            hits = F.count_if(trimmed(name) == "NA")
            rows.append((f"{label}.{name}", {"na_count": hits, "pct": percent(hits, _rows())}))
        return measured(raw[dataset], rows, "check_name")

    return rates(
        "inpatient", "Inpatient", ["OperatingPhysician", "OtherPhysician", "DeductibleAmtPaid"]
    ).unionByName(rates("beneficiary", "Beneficiary", ["DOD"]))


def amounts(raw: Raw) -> DataFrame:
    """Distribution of the reimbursed amount per claim file."""
    amount = as_int("InscClaimAmtReimbursed")

    def spread(dataset: str, label: str) -> DataFrame:
        return raw[dataset].agg(
            F.lit(label).alias("claim_type"),
            F.min(amount).alias("min_amt"),
            F.max(amount).alias("max_amt"),
            mean(amount).alias("avg_amt"),
            F.round(F.stddev_samp(amount), 6).alias("stddev_amt"),
            F.count_if(amount > 100000).alias("claims_over_100k"),
        )

    return spread("inpatient", "Inpatient").unionByName(spread("outpatient", "Outpatient"))


def date_ranges(raw: Raw) -> DataFrame:
    """First and last day with the calendar months (years for births) in between."""

    def span(dataset: str, label: str, start: str, end: str, gap) -> DataFrame:
        one = raw[dataset].agg(
            F.lit(label).alias("source"),
            F.min(as_date(start)).alias("earliest"),
            F.max(as_date(end)).alias("latest"),
        )
        return one.withColumn("span_units", gap("earliest", "latest"))

    return union_all(
        [
            span("inpatient", "Inpatient Claims", "ClaimStartDt", "ClaimEndDt", month_gap),
            span("outpatient", "Outpatient Claims", "ClaimStartDt", "ClaimEndDt", month_gap),
            span("beneficiary", "Beneficiary DOB range", "DOB", "DOB", year_gap),
        ]
    )


def durations(raw: Raw) -> DataFrame:
    def days(start: str, end: str) -> dict[str, Column]:
        gap = F.date_diff(as_date(end), as_date(start))
        return {"min_days": F.min(gap), "max_days": F.max(gap), "avg_days": mean(gap)}

    claim, stay = days("ClaimStartDt", "ClaimEndDt"), days("AdmissionDt", "DischargeDt")
    return measured(
        raw["inpatient"],
        [("Inpatient claim duration", claim), ("Inpatient admission duration", stay)],
        "metric",
    ).unionByName(measured(raw["outpatient"], [("Outpatient claim duration", claim)], "metric"))


def same_day(raw: Raw) -> DataFrame:
    hits = F.count_if(as_date("AdmissionDt") == as_date("DischargeDt"))
    return raw["inpatient"].agg(
        hits.alias("same_day_admissions"), percent(hits, _rows()).alias("pct_of_inpatient")
    )


def ages(raw: Raw, reference: str = AGE_REFERENCE_DATE) -> DataFrame:
    age = year_gap(as_date("DOB"), F.lit(reference).cast("date"))
    return (
        raw["beneficiary"]
        .filter(~is_blank("DOB"))
        .agg(
            F.min(age).alias("min_age"),
            F.max(age).alias("max_age"),
            mean(age).alias("avg_age"),
            F.count_if(age < 65).alias("under_65_count"),
            F.count_if(age >= 65).alias("over_65_count"),
            F.count_if(age > 100).alias("over_100_count"),
        )
    )


def code_fill(raw: Raw) -> DataFrame:
    """Average number of filled code slots per claim."""

    def average(names: list[str]) -> dict[str, Column]:
        return {"avg_value": mean(filled_count(names))}

    return measured(
        raw["inpatient"],
        [
            ("Inpatient diagnosis codes", average(DIAGNOSIS_COLUMNS)),
            ("Inpatient procedure codes", average(PROCEDURE_COLUMNS)),
        ],
        "metric",
    ).unionByName(
        measured(
            raw["outpatient"],
            [("Outpatient diagnosis codes", average(DIAGNOSIS_COLUMNS))],
            "metric",
        )
    )


def provider_coverage(raw: Raw) -> DataFrame:
    """Providers in labels and claims, claims' providers without a label, label counts."""
    ids = {
        name: raw[name].select(trimmed("Provider").alias("id")).distinct()
        for name in ("provider", "inpatient", "outpatient")
    }

    def count(df: DataFrame, metric: str) -> DataFrame:
        return df.agg(F.lit(metric).alias("metric"), F.count("id").alias("providers"))

    claimed = ids["inpatient"].union(ids["outpatient"]).distinct()
    label = trimmed("PotentialFraud")
    labels = measured(
        raw["provider"],
        [
            ("Labelled Yes", {"providers": F.count_if(label == "Yes")}),
            ("Labelled No", {"providers": F.count_if(label == "No")}),
        ],
        "metric",
    )
    return union_all(
        [
            count(ids["provider"], "In label table"),
            count(ids["inpatient"], "In inpatient claims"),
            count(ids["outpatient"], "In outpatient claims"),
            count(claimed.join(ids["provider"], "id", "left_anti"), "In claims without label"),
            labels,
        ]
    )


# --- structure -----------------------------------------------------------------------

QUOTED = {
    "provider": ["Provider", "PotentialFraud"],
    "inpatient": ["BeneID", "ClaimID", "Provider"],
    "outpatient": ["BeneID", "ClaimID", "Provider"],
    "beneficiary": ["BeneID", "RenalDiseaseIndicator"],
}


def stray_quotes(raw: Raw) -> DataFrame:
    """Rows with a double quote left in a key column."""
    return union_all(
        [
            measured(
                raw[dataset],
                [
                    (
                        f"{NAMES[dataset]}.{name}",
                        {"rows_with_quote": F.count_if(F.col(name).contains('"'))},
                    )
                    for name in names
                ],
                "column_name",
            )
            for dataset, names in QUOTED.items()
        ]
    )


def blank_rows(raw: Raw) -> DataFrame:
    """Rows without any key value."""
    keys = {
        "provider": is_blank("Provider") & is_blank("PotentialFraud"),
        "inpatient": is_blank("BeneID") & is_blank("ClaimID"),
        "outpatient": is_blank("BeneID") & is_blank("ClaimID"),
        "beneficiary": is_blank("BeneID"),
    }
    return union_all(
        [
            raw[dataset].agg(
                F.lit(NAMES[dataset]).alias("table_name"), F.count_if(blank).alias("blank_rows")
            )
            for dataset, blank in keys.items()
        ]
    )


def latest(df: DataFrame, dataset: str, limit: int = 5) -> DataFrame:
    """Newest rows of a bronze table, equal load times in key order."""
    keys = [name for name in PRIMARY_KEYS[dataset]]
    others = [F.asc_nulls_last(name) for name in RAW_COLUMNS[dataset] if name not in keys]
    return df.orderBy(F.desc("ingestion_timestamp"), *keys, *others).limit(limit)


def bronze_counts(raw: Raw, expected: dict[str, int]) -> DataFrame:
    return union_all(
        [
            raw[dataset].agg(
                F.lit(NAMES[dataset]).alias("table_name"),
                _rows().alias("row_count"),
                F.lit(expected.get(dataset)).cast("bigint").alias("expected_count"),
            )
            for dataset in DATASETS
        ]
    )
