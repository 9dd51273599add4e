"""Raw text, staging, gold, profiling and gates with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimward.catalog import business
from claimward.catalog.metric_queries import RANGE_COLUMNS
from claimward.catalog.business import doubles
from claimward.catalog.star_sql import mean
from claimward.catalog.text_sql import GOLD, RAW, STAGING, day, gap, num, slots
from claimward.config import CONDITION_FLAGS, PUBLIC_ROW_COUNTS, Expectations
from claimward.operators import checks, distinct, gold, lattice, profile, silver
from claimward.operators.tally import union_all
from claimward.plans import reports
from claimward.plans.refresh import gold_from_silver, published_model, refresh
from claimward.schemas import (
    DATASETS,
    DIAGNOSIS_COLUMNS,
    PRIMARY_KEYS,
    PROCEDURE_COLUMNS,
    RAW_COLUMNS,
    REQUIRED,
)
from claimward.session import hash_joins, scratch_path, short_methods
from claimward.sources import lookups, star_text, tables, text

BATCH = "20240101_000000"


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    short_methods(spark)
    hash_joins(spark)
    return star_text.raw(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = raw(spark, sf_dir)
    return {**frames, "beneficiary": text.strip_quotes(frames["beneficiary"])}


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return silver.silver(cleaned(spark, sf_dir))


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return gold_from_silver(spark, staging(spark, sf_dir))


def over_raw(function):
    return lambda spark, sf_dir: function(raw(spark, sf_dir))


def over_staging(function):
    return lambda spark, sf_dir: doubles(function(staging(spark, sf_dir)))


def over_gold(function):
    return lambda spark, sf_dir: doubles(function(star(spark, sf_dir)))


def csv_paths(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, str]:
    """The named raw datasets, or all, written as CSV files into the shared folder."""
    root = scratch_path(spark, "csv")
    paths = {}
    for name, df in raw(spark, sf_dir).items():
        if names and name not in names:
            continue
        paths[name] = f"{root}/{name}"
        (
            df.write.option("header", True)
            .option("escape", '"')
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(paths[name])
        )
    return paths


# --- sources and sinks ---------------------------------------------------------------


def csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = csv_paths(spark, sf_dir, "inpatient")
    return text.read_text(spark, paths["inpatient"], "inpatient").select(*RAW_COLUMNS["inpatient"])


def csv_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = text.read_all(spark, csv_paths(spark, sf_dir), BATCH)
    return union_all(
        [
            df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count"))
            for name, df in frames.items()
        ]
    )


def csv_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = text.read_all(spark, csv_paths(spark, sf_dir), BATCH)
    return union_all(
        [
            df.groupBy("batch_id").agg(
                F.lit(name).alias("dataset"),
                F.count("ingestion_timestamp").alias("stamped_rows"),
                F.count_if(F.col("source_file_name").endswith(".csv")).alias("rows_with_file"),
            )
            for name, df in frames.items()
        ]
    )


def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = text.source_sizes(spark, csv_paths(spark, sf_dir))
    return sizes.select("dataset", (F.col("bytes") > 0).alias("present"))


def bronze_written(spark: SparkSession, sf_dir: str) -> list[tables.Staged]:
    root = scratch_path(spark, "bronze")
    return [
        tables.stage(df, root, "bronze", name, BATCH) for name, df in raw(spark, sf_dir).items()
    ]


def sink_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset written, read back and returned as stored."""
    root = scratch_path(spark, "bronze")
    done = tables.stage(raw(spark, sf_dir)["beneficiary"], root, "bronze", "beneficiary", BATCH)
    return tables.staged_frame(spark, done)


def sink_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.staged_counts(spark, bronze_written(spark, sf_dir))


def sink_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.reconcile(spark, bronze_written(spark, sf_dir), PUBLIC_ROW_COUNTS)


def sink_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = profile.profile_all_columns(raw(spark, sf_dir))
    return tables.write_report(report, scratch_path(spark, "profile"))


_refreshed: dict[tuple[str, str], str] = {}


def refreshed_root(spark: SparkSession, sf_dir: str) -> str:
    """A full refresh of the tables as raw text, once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _refreshed:
        root = scratch_path(spark, "refresh")
        refresh(spark, raw(spark, sf_dir), root, BATCH, Expectations.none(), strict=False)
        _refreshed[key] = root
    return _refreshed[key]


def over_published(function):
    return lambda spark, sf_dir: function(published_model(spark, refreshed_root(spark, sf_dir)))


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and reject findings as stored with a published batch."""
    stored = tables.read_published(spark, refreshed_root(spark, sf_dir), "checks")["findings"]
    return stored.filter(
        F.col("check_name").endswith("not unique") | F.col("check_name").endswith("unknown label")
    )


def sink_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every published table of the three layers with its row count after a full refresh."""
    published = tables.current(spark, refreshed_root(spark, sf_dir))
    return published.filter("layer in ('bronze', 'silver', 'gold')").select(
        "layer", "table_name", "batch_id", "table_rows"
    )


def gold_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published gold tables loaded whole and counted."""
    loaded = tables.read_published(spark, refreshed_root(spark, sf_dir), "gold")
    return union_all(
        [
            df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
            for name, df in loaded.items()
        ]
    )


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every state with its patients, and patients whose code is on no list."""
    patients = (
        staging(spark, sf_dir)["stg_beneficiary"]
        .groupBy("state_code")
        .agg(F.count(F.lit(1)).alias("beneficiaries"))
    )
    return (
        patients.join(lookups.states(spark), "state_code", "full")
        .withColumn("beneficiaries", F.coalesce("beneficiaries", F.lit(0).cast("bigint")))
    )


# --- SQL helpers ---------------------------------------------------------------------

KEY_TABLES = {name: profile.NAMES[name] for name in DATASETS}
COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, count(*) AS row_count FROM {table}"
    for name, table in KEY_TABLES.items()
)


def blank(name: str) -> str:
    return f"({name} IS NULL OR trim({name}) = '')"


def where(table: str, rows: list[tuple[str, str]], name: str = "check_name", value: str = "issue_count") -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS {name}, count(*) FILTER (WHERE {bad}) AS {value} FROM {table}"
        for label, bad in rows
    )


def check_sql(layer: str, parts: list[tuple[str, list[tuple[str, str, str]]]]) -> str:
    """Uniform check rows from (table, [(name, bad row, severity)])."""
    rows = " UNION ALL ".join(
        f"SELECT '{label}' AS check_name, count(*) FILTER (WHERE {bad}) AS issue_count, '{level}' AS severity FROM {table}"
        for table, items in parts
        for label, bad, level in items
    )
    return f"SELECT '{layer}' AS layer, check_name, issue_count, severity, issue_count = 0 AS passed FROM ({rows})"


def profile_sql() -> str:
    parts = []
    for dataset, table in KEY_TABLES.items():
        for name in RAW_COLUMNS[dataset]:
            parts.append(
                f"""SELECT '{dataset}' AS dataset, '{name}' AS column_name,
                count(*) FILTER (WHERE {name} IS NULL) AS null_count,
                count(*) FILTER (WHERE {name} = '') AS blank_count,
                count(*) FILTER (WHERE {name} = 'NA') AS na_count, count(DISTINCT {name}) AS distinct_count,
                (SELECT string_agg(v || '=' || n, '; ' ORDER BY n DESC, v) FROM
                  (SELECT {name} AS v, count(*) AS n FROM {table} WHERE {name} IS NOT NULL GROUP BY 1
                   ORDER BY n DESC, v LIMIT 5)) AS top_values FROM {table}"""
            )
    return " UNION ALL ".join(parts)


def bronze_sql() -> str:
    parts = []
    for dataset, table in KEY_TABLES.items():
        expected = PUBLIC_ROW_COUNTS[dataset]
        (key,) = PRIMARY_KEYS[dataset]
        rows = [(f"{table}: row count", f"abs(count(*) - {expected})", "critical")]
        rows += [
            (f"{table}.{c}: missing", f"count(*) FILTER (WHERE {blank(c)})", "critical")
            for c in REQUIRED[dataset]
        ]
        rows.append(
            (f"{table}: duplicate key rows", f"count(*) - count(DISTINCT coalesce({key}, ''))", "critical")
        )
        for c in RAW_COLUMNS[dataset]:
            if c in ("ClaimStartDt", "ClaimEndDt", "AdmissionDt", "DischargeDt", "DOB", "DOD"):
                bad = f"coalesce(trim({c}), '') <> 'NA' AND {day(c)} IS NULL"
                rows.append((f"{table}.{c}: not a date", f"count(*) FILTER (WHERE {bad})", "warning"))
        for c in RAW_COLUMNS[dataset]:
            if "Amt" in c or "Reimbursed" in c or "Deductible" in c:
                bad = f"{num(c, 'DOUBLE')} < 0"
                rows.append((f"{table}.{c}: negative", f"count(*) FILTER (WHERE {bad})", "warning"))
        parts += [
            f"SELECT '{label}' AS check_name, {count} AS issue_count, '{level}' AS severity FROM {table}"
            for label, count, level in rows
        ]
    inner = " UNION ALL ".join(parts)
    return f"SELECT 'bronze' AS layer, check_name, issue_count, severity, issue_count = 0 AS passed FROM ({inner})"


def bad_date(c: str) -> str:
    return f"NOT {blank(c)} AND {day(c)} IS NULL"


AMOUNT_IN = num("InscClaimAmtReimbursed")
SILVER_NULLS = [
    (
        table,
        [
            (f"{table}.{c}: null", f"{c} IS NULL", "critical" if c.endswith("_id") else "warning")
            for c in names
        ],
    )
    for table, names in {
        "stg_provider": ["provider_id", "is_potential_fraud"],
        "stg_beneficiary": ["beneficiary_id", "date_of_birth", "gender", "patient_age", "age_group", "is_deceased", "chronic_condition_count"],
        "stg_claims": ["claim_id", "beneficiary_id", "provider_id", "claim_type", "claim_start_date", "claim_end_date", "claim_reimbursement_amt"],
    }.items()
]
SILVER_DOMAINS = [
    ("stg_provider", [("stg_provider: fraud flag outside true/false", "CAST(is_potential_fraud AS INTEGER) NOT IN (0, 1)", "warning")]),
    ("stg_beneficiary", [
        ("stg_beneficiary: gender outside Male/Female", "gender NOT IN ('Male', 'Female')", "warning"),
        ("stg_beneficiary: age group unknown", "age_group NOT IN ('Below 45', '45-54', '55-64', '65+')", "warning"),
        ("stg_beneficiary: renal indicator outside 0/1", "renal_disease_indicator NOT IN (0, 1)", "warning"),
        ("stg_beneficiary: condition flags outside 0/1", " OR ".join(f"{c} NOT IN (0, 1)" for c in CONDITION_FLAGS), "warning"),
    ]),
    ("stg_claims", [
        ("stg_claims: claim type unknown", "claim_type NOT IN ('Inpatient', 'Outpatient')", "warning"),
        ("stg_claims: zero flag outside true/false", "CAST(is_zero_reimbursement AS INTEGER) NOT IN (0, 1)", "warning"),
    ]),
]
SILVER_DERIVED = [
    ("stg_beneficiary", [
        ("stg_beneficiary: age group does not fit age",
         "age_group <> CASE WHEN patient_age < 45 THEN 'Below 45' WHEN patient_age < 55 THEN '45-54' "
         "WHEN patient_age < 65 THEN '55-64' WHEN patient_age >= 65 THEN '65+' END", "warning"),
        ("stg_beneficiary: death flag does not fit death date", "is_deceased <> (date_of_death IS NOT NULL)", "warning"),
        ("stg_beneficiary: condition count is not the flag sum", f"chronic_condition_count <> {' + '.join(CONDITION_FLAGS)}", "warning"),
    ]),
    ("stg_claims", [
        ("stg_claims: duration is not the date difference", "claim_duration_days <> claim_end_date - claim_start_date", "warning"),
        ("stg_claims: stay is not the date difference", "claim_type = 'Inpatient' AND admission_duration_days <> discharge_date - admission_date", "warning"),
        ("stg_claims: zero flag does not fit amount", "is_zero_reimbursement <> (claim_reimbursement_amt = 0)", "warning"),
        ("stg_claims: same-day flag does not fit dates", "claim_type = 'Inpatient' AND is_same_day_discharge <> (admission_date = discharge_date)", "warning"),
        ("stg_claims: outpatient with admission date", "claim_type = 'Outpatient' AND admission_date IS NOT NULL", "warning"),
        ("stg_claims: outpatient with same-day flag", "claim_type = 'Outpatient' AND is_same_day_discharge IS NOT NULL", "warning"),
    ]),
]
SILVER_REFS = [
    ("stg_claims", [
        ("stg_claims.beneficiary_id: not in stg_beneficiary", "beneficiary_id NOT IN (SELECT beneficiary_id FROM stg_beneficiary)", "warning"),
        ("stg_claims.provider_id: not in stg_provider", "provider_id NOT IN (SELECT provider_id FROM stg_provider)", "warning"),
    ]),
]
SILVER_NA = [
    ("stg_claims", [
        (f"stg_claims.{c}: placeholder left", f"CAST({c} AS VARCHAR) = 'NA'", "critical")
        for c in ("attending_physician_id", "operating_physician_id", "other_physician_id", "diagnosis_code_1", "procedure_code_1", "deductible_amt_paid")
    ]),
    ("stg_beneficiary", [("stg_beneficiary.date_of_death: placeholder left", "CAST(date_of_death AS VARCHAR) = 'NA'", "critical")]),
]
GOLD_REFS = [
    ("fact_claims", [
        ("fact_claims.provider_key: not in dim_provider", "provider_key NOT IN (SELECT provider_key FROM dim_provider)", "critical"),
        ("fact_claims.beneficiary_key: not in dim_beneficiary", "beneficiary_key NOT IN (SELECT beneficiary_key FROM dim_beneficiary)", "critical"),
        ("fact_claims.claim_start_date_key: not in dim_date", "claim_start_date_key NOT IN (SELECT date_key FROM dim_date)", "warning"),
        ("fact_claims.provider_key: null", "provider_key IS NULL", "critical"),
        ("fact_claims.beneficiary_key: null", "beneficiary_key IS NULL", "critical"),
        ("fact_claims.claim_start_date_key: null", "claim_start_date_key IS NULL", "warning"),
    ]),
]
GOLD_FACT = [
    ("fact_claims", [
        ("fact_claims: claim type unknown", "claim_type NOT IN ('Inpatient', 'Outpatient')", "warning"),
        ("fact_claims.claim_type: null", "claim_type IS NULL", "critical"),
        ("fact_claims.is_potential_fraud: null", "is_potential_fraud IS NULL", "warning"),
        ("fact_claims.claim_reimbursement_amt: null", "claim_reimbursement_amt IS NULL", "warning"),
    ]),
]
GOLD_DIMS = [
    ("dim_provider", [
        ("dim_provider: fraud flag outside true/false", "CAST(is_potential_fraud AS INTEGER) NOT IN (0, 1)", "warning"),
        ("dim_provider: label unknown", "fraud_label NOT IN ('Fraud', 'Not Fraud')", "warning"),
    ]),
    ("dim_beneficiary", [
        ("dim_beneficiary.patient_age: null", "patient_age IS NULL", "warning"),
        ("dim_beneficiary.age_group: null", "age_group IS NULL", "warning"),
    ]),
    ("dim_geography", [("dim_geography.state_name: null", "state_name IS NULL", "warning")]),
    ("dim_date", [("dim_date.year_month: null", "year_month IS NULL", "warning")]),
]
GOLD_TABLES = ["dim_provider", "dim_beneficiary", "dim_date", "dim_geography", "fact_claims", "agg_provider_summary", "agg_state_monthly", "agg_chronic_disease"]
GOLD_COUNT_ROWS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in GOLD_TABLES
)


def spread_sql(label: str, table: str, value: str, outside: str, cond: str = "true") -> str:
    return (
        f"SELECT '{label}' AS metric, CAST(min({value}) AS BIGINT) AS min_val, CAST(max({value}) AS BIGINT) AS max_val, "
        f"CAST(sum({value}) AS DOUBLE) / count({value}) AS avg_val, count(*) FILTER (WHERE {outside}) AS outside "
        f"FROM {table} WHERE {cond}"
    )


IP, OP = "claim_type = 'Inpatient'", "claim_type = 'Outpatient'"
AMT = "claim_reimbursement_amt"


def tiers_sql(table: str) -> str:
    return f"""SELECT 'age group count' AS metric, age_group AS item, CAST(count(*) AS DOUBLE) AS value FROM {table} GROUP BY age_group
    UNION ALL SELECT 'age group %', age_group, round(count(*) * 100 / sum(count(*)) OVER (), 2) FROM {table} GROUP BY age_group"""


EXPECT = Expectations.public()


def counts_sql(rows: str, expected: dict[str, int]) -> str:
    known = ", ".join(f"('{k}', {v})" for k, v in expected.items())
    return f"""SELECT x.*, CAST(e.n AS BIGINT) AS expected, e.n IS NULL OR e.n = row_count AS matched
    FROM ({rows}) x LEFT JOIN (VALUES {known}) AS e(t, n) ON e.t = x.table_name"""


SILVER_COUNT_ROWS = """SELECT 'stg_provider' AS table_name, count(*) AS row_count FROM stg_provider
UNION ALL SELECT 'stg_beneficiary', count(*) FROM stg_beneficiary
UNION ALL SELECT 'stg_claims', count(*) FROM stg_claims
UNION ALL SELECT 'stg_claims (' || claim_type || ')', count(*) FROM stg_claims GROUP BY claim_type"""


QUERIES = {
    # --- sources and sinks -------------------------------------------------------
    "src_csv_text": (
        csv_text,
        RAW
        + "SELECT "
        + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS["inpatient"])
        + " FROM raw_inpatient",
    ),
    "src_all": (csv_all, RAW + COUNTS),
    "src_audit": (
        csv_audit,
        RAW
        + f"SELECT '{BATCH}' AS batch_id, dataset, row_count AS stamped_rows, row_count AS rows_with_file FROM ({COUNTS})",
    ),
    "src_presence": (presence, RAW + f"SELECT dataset, row_count > 0 AS present FROM ({COUNTS})"),
    "src_quote_strip": (
        lambda spark, sf_dir: cleaned(spark, sf_dir)["beneficiary"].select(
            "BeneID", "RenalDiseaseIndicator"
        ),
        RAW
        + """SELECT replace(BeneID, '"', '') AS BeneID, replace(RenalDiseaseIndicator, '"', '') AS RenalDiseaseIndicator
        FROM raw_beneficiary""",
    ),
    "src_geography": (
        geography,
        RAW
        + STAGING
        + GOLD
        + """SELECT coalesce(x.state_code, g.state_code) AS state_code, coalesce(n, 0) AS beneficiaries,
        geo_key, state_name, state_abbr, region
        FROM (SELECT state_code, count(*) AS n FROM stg_beneficiary GROUP BY state_code) x
        FULL JOIN dim_geography g ON g.state_code = x.state_code""",
    ),
    "src_gold_import": (gold_import, RAW + STAGING + GOLD + GOLD_COUNT_ROWS),
    "snk_bronze": (sink_bronze, RAW + "SELECT * FROM raw_beneficiary"),
    "snk_all": (
        sink_all,
        RAW + f"SELECT 'bronze' AS layer, dataset AS table_name, row_count AS rows_written FROM ({COUNTS})",
    ),
    "snk_reconcile": (
        sink_reconcile,
        RAW
        + f"""SELECT 'bronze' AS layer, dataset AS table_name, row_count AS rows_written, CAST(e.n AS BIGINT) AS expected_rows,
        row_count = e.n AS matched FROM ({COUNTS}) JOIN (VALUES
        {", ".join(f"('{k}', {v})" for k, v in PUBLIC_ROW_COUNTS.items())}) AS e(d, n) ON d = dataset""",
    ),
    "snk_profile_report": (sink_report, RAW + profile_sql()),
    "snk_full_refresh": (
        sink_refresh,
        RAW
        + STAGING
        + GOLD
        + f"""SELECT 'bronze' AS layer, dataset AS table_name, '{BATCH}' AS batch_id, row_count AS table_rows FROM ({COUNTS})
        UNION ALL SELECT 'silver', table_name, '{BATCH}', row_count FROM ({SILVER_COUNT_ROWS}) WHERE table_name NOT LIKE '%(%'
        UNION ALL SELECT 'gold', table_name, '{BATCH}', row_count FROM ({GOLD_COUNT_ROWS})""",
    ),
    # --- profiling ---------------------------------------------------------------
    "prf_columns": (
        lambda spark, sf_dir: profile.profile_all_columns(raw(spark, sf_dir)),
        RAW + profile_sql(),
    ),
    "prf_all": (
        over_raw(lambda r: profile.profile_all(r, PUBLIC_ROW_COUNTS)),
        RAW
        + " UNION ALL ".join(
            f"""SELECT '{d}' AS dataset, count(*) AS row_count, CAST({PUBLIC_ROW_COUNTS[d]} AS BIGINT) AS expected_rows,
            count(*) = {PUBLIC_ROW_COUNTS[d]} AS row_count_match, {len(RAW_COLUMNS[d])} AS column_count,
            count(*) - count(DISTINCT coalesce({PRIMARY_KEYS[d][0]}, '')) AS pk_duplicates FROM {t}"""
            for d, t in KEY_TABLES.items()
        ),
    ),
    "prf_null_keys": (
        over_raw(profile.null_keys),
        RAW
        + " UNION ALL ".join(
            where(t, [(f"{t}.{c}", blank(c)) for c in names], value="null_count")
            for t, names in {
                "raw_provider": ["Provider"],
                "raw_inpatient": ["BeneID", "ClaimID", "Provider"],
                "raw_outpatient": ["BeneID", "ClaimID", "Provider"],
                "raw_beneficiary": ["BeneID"],
            }.items()
        ),
    ),
    "prf_dup_groups": (
        over_raw(profile.duplicate_groups),
        RAW
        + " UNION ALL ".join(
            f"""SELECT '{t}.{PRIMARY_KEYS[d][0]}' AS check_name, count(*) AS duplicate_groups FROM
            (SELECT {PRIMARY_KEYS[d][0]} FROM {t} GROUP BY 1 HAVING count(*) > 1)"""
            for d, t in KEY_TABLES.items()
        ),
    ),
    "prf_overlap": (
        over_raw(profile.overlap),
        RAW
        + """SELECT count(*) AS claim_ids_in_both FROM
        (SELECT ClaimID FROM raw_inpatient INTERSECT SELECT ClaimID FROM raw_outpatient)""",
    ),
    "prf_orphans": (
        over_raw(profile.orphans),
        RAW
        + " UNION ALL ".join(
            f"""SELECT '{t}.{c} without parent' AS check_name, count(*) AS issue_count FROM {t}
            WHERE trim({c}) NOT IN (SELECT trim({c}) FROM {p})"""
            for t in ("raw_inpatient", "raw_outpatient")
            for c, p in (("BeneID", "raw_beneficiary"), ("Provider", "raw_provider"))
        ),
    ),
    "prf_dates": (
        over_raw(profile.dates),
        RAW
        + " UNION ALL ".join(
            [
                where(
                    "raw_inpatient",
                    [(f"Inpatient: {c} not a valid date", bad_date(c)) for c in ("ClaimStartDt", "ClaimEndDt", "AdmissionDt", "DischargeDt")]
                    + [
                        ("Inpatient: ClaimEndDt before ClaimStartDt", f"{day('ClaimEndDt')} < {day('ClaimStartDt')}"),
                        ("Inpatient: DischargeDt before AdmissionDt", f"{day('DischargeDt')} < {day('AdmissionDt')}"),
                    ],
                ),
                where(
                    "raw_outpatient",
                    [
                        ("Outpatient: ClaimStartDt not a valid date", bad_date("ClaimStartDt")),
                        ("Outpatient: ClaimEndDt before ClaimStartDt", f"{day('ClaimEndDt')} < {day('ClaimStartDt')}"),
                    ],
                ),
                where(
                    "raw_beneficiary",
                    [
                        ("Beneficiary: DOB not a valid date", bad_date("DOB")),
                        ("Beneficiary: DOD not a valid date", f"{bad_date('DOD')} AND trim(DOD) <> 'NA'"),
                        ("Beneficiary: DOD before DOB", f"{day('DOD')} < {day('DOB')}"),
                    ],
                ),
            ]
        ),
    ),
    "prf_numeric": (
        over_raw(profile.numbers),
        RAW
        + " UNION ALL ".join(
            [
                where(
                    "raw_inpatient",
                    [
                        ("Inpatient: InscClaimAmtReimbursed not numeric", f"{AMOUNT_IN} IS NULL"),
                        ("Inpatient: InscClaimAmtReimbursed negative or zero", f"{AMOUNT_IN} <= 0"),
                        ("Inpatient: DeductibleAmtPaid not numeric", f"trim(DeductibleAmtPaid) <> 'NA' AND {num('DeductibleAmtPaid', 'DOUBLE')} IS NULL"),
                    ],
                ),
                where(
                    "raw_outpatient",
                    [
                        ("Outpatient: InscClaimAmtReimbursed not numeric", f"{AMOUNT_IN} IS NULL"),
                        ("Outpatient: InscClaimAmtReimbursed negative or zero", f"{AMOUNT_IN} <= 0"),
                    ],
                ),
                "SELECT 'Beneficiary: Gender values present', count(DISTINCT Gender) FROM raw_beneficiary",
                where(
                    "raw_beneficiary",
                    [("Beneficiary: Chronic flag values outside 1/2", "trim(ChronicCond_Alzheimer) NOT IN ('1', '2')")],
                ),
            ]
        ),
    ),
    "prf_domains": (
        over_raw(profile.domains),
        RAW
        + """SELECT DISTINCT 'PotentialFraud' AS column_name, PotentialFraud AS value FROM raw_provider
        UNION ALL SELECT DISTINCT 'Gender', Gender FROM raw_beneficiary
        UNION ALL SELECT DISTINCT 'RenalDiseaseIndicator', RenalDiseaseIndicator FROM raw_beneficiary""",
    ),
    "prf_na_rate": (
        over_raw(profile.na_rates),
        RAW
        + " UNION ALL ".join(
            f"""SELECT '{label}.{c}' AS check_name, count(*) FILTER (WHERE trim({c}) = 'NA') AS na_count,
            CAST(count(*) FILTER (WHERE trim({c}) = 'NA') AS DOUBLE) / count(*) * 100 AS pct FROM {t}"""
            for label, t, c in (
                ("Inpatient", "raw_inpatient", "OperatingPhysician"),
                ("Inpatient", "raw_inpatient", "OtherPhysician"),
                ("Inpatient", "raw_inpatient", "DeductibleAmtPaid"),
                ("Beneficiary", "raw_beneficiary", "DOD"),
            )
        ),
    ),
    "prf_amount_dist": (
        over_raw(profile.amounts),
        RAW
        + " UNION ALL ".join(
            f"""SELECT '{label}' AS claim_type, min({AMOUNT_IN}) AS min_amt, max({AMOUNT_IN}) AS max_amt,
            {mean(AMOUNT_IN)} AS avg_amt, round(stddev_samp({AMOUNT_IN}), 6) AS stddev_amt,
            count(*) FILTER (WHERE {AMOUNT_IN} > 100000) AS claims_over_100k FROM {t}"""
            for label, t in (("Inpatient", "raw_inpatient"), ("Outpatient", "raw_outpatient"))
        ),
    ),
    "prf_date_range": (
        over_raw(profile.date_ranges),
        RAW
        + " UNION ALL ".join(
            f"""SELECT '{label}' AS source, min({day(a)}) AS earliest, max({day(b)}) AS latest,
            CAST(date_diff('{unit}', min({day(a)}), max({day(b)})) AS INTEGER) AS span_units FROM {t}"""
            for label, t, a, b, unit in (
                ("Inpatient Claims", "raw_inpatient", "ClaimStartDt", "ClaimEndDt", "month"),
                ("Outpatient Claims", "raw_outpatient", "ClaimStartDt", "ClaimEndDt", "month"),
                ("Beneficiary DOB range", "raw_beneficiary", "DOB", "DOB", "year"),
            )
        ),
    ),
    "prf_durations": (
        over_raw(profile.durations),
        RAW
        + " UNION ALL ".join(
            f"""SELECT '{label}' AS metric, min({gap(day(a), day(b))}) AS min_days, max({gap(day(a), day(b))}) AS max_days,
            {mean(gap(day(a), day(b)))} AS avg_days FROM {t}"""
            for label, t, a, b in (
                ("Inpatient claim duration", "raw_inpatient", "ClaimStartDt", "ClaimEndDt"),
                ("Inpatient admission duration", "raw_inpatient", "AdmissionDt", "DischargeDt"),
                ("Outpatient claim duration", "raw_outpatient", "ClaimStartDt", "ClaimEndDt"),
            )
        ),
    ),
    "prf_same_day": (
        over_raw(profile.same_day),
        RAW
        + f"""SELECT count(*) FILTER (WHERE {day('AdmissionDt')} = {day('DischargeDt')}) AS same_day_admissions,
        CAST(count(*) FILTER (WHERE {day('AdmissionDt')} = {day('DischargeDt')}) AS DOUBLE) / count(*) * 100
          AS pct_of_inpatient FROM raw_inpatient""",
    ),
    "prf_age": (
        over_raw(profile.ages),
        RAW
        + f""", x AS (SELECT CAST(2009 - year({day('DOB')}) AS INTEGER) AS age FROM raw_beneficiary WHERE NOT {blank('DOB')})
        SELECT min(age) AS min_age, max(age) AS max_age, {mean('age')} AS avg_age,
        count(*) FILTER (WHERE age < 65) AS under_65_count, count(*) FILTER (WHERE age >= 65) AS over_65_count,
        count(*) FILTER (WHERE age > 100) AS over_100_count FROM x""",
    ),
    "prf_code_fill": (
        over_raw(profile.code_fill),
        RAW
        + " UNION ALL ".join(
            f"SELECT '{label}' AS metric, {mean(slots(names))} AS avg_value FROM {t}"
            for label, names, t in (
                ("Inpatient diagnosis codes", DIAGNOSIS_COLUMNS, "raw_inpatient"),
                ("Inpatient procedure codes", PROCEDURE_COLUMNS, "raw_inpatient"),
                ("Outpatient diagnosis codes", DIAGNOSIS_COLUMNS, "raw_outpatient"),
            )
        ),
    ),
    "prf_provider_coverage": (
        over_raw(profile.provider_coverage),
        RAW
        + """SELECT 'In label table' AS metric, count(DISTINCT trim(Provider)) AS providers FROM raw_provider
        UNION ALL SELECT 'In inpatient claims', count(DISTINCT trim(Provider)) FROM raw_inpatient
        UNION ALL SELECT 'In outpatient claims', count(DISTINCT trim(Provider)) FROM raw_outpatient
        UNION ALL SELECT 'In claims without label', count(*) FROM (SELECT trim(Provider) FROM raw_inpatient UNION
          SELECT trim(Provider) FROM raw_outpatient EXCEPT SELECT trim(Provider) FROM raw_provider)
        UNION ALL SELECT 'Labelled Yes', count(*) FROM raw_provider WHERE trim(PotentialFraud) = 'Yes'
        UNION ALL SELECT 'Labelled No', count(*) FROM raw_provider WHERE trim(PotentialFraud) = 'No'""",
    ),
    "prf_stray_quotes": (
        over_raw(profile.stray_quotes),
        RAW
        + " UNION ALL ".join(
            where(KEY_TABLES[d], [(f"{KEY_TABLES[d]}.{c}", f"{c} LIKE '%\"%'") for c in names], "column_name", "rows_with_quote")
            for d, names in profile.QUOTED.items()
        ),
    ),
    "prf_blank_rows": (
        over_raw(profile.blank_rows),
        RAW
        + " UNION ALL ".join(
            where(t, [(t, cond)], "table_name", "blank_rows")
            for t, cond in (
                ("raw_provider", f"{blank('Provider')} AND {blank('PotentialFraud')}"),
                ("raw_inpatient", f"{blank('BeneID')} AND {blank('ClaimID')}"),
                ("raw_outpatient", f"{blank('BeneID')} AND {blank('ClaimID')}"),
                ("raw_beneficiary", blank("BeneID")),
            )
        ),
    ),
    "prf_latest": (
        lambda spark, sf_dir: profile.latest(
            raw(spark, sf_dir)["beneficiary"].withColumn("ingestion_timestamp", F.current_timestamp()),
            "beneficiary",
        ).drop("ingestion_timestamp"),
        RAW + "SELECT * FROM raw_beneficiary ORDER BY BeneID LIMIT 5",
    ),
    "prf_bronze_counts": (
        over_raw(lambda r: profile.bronze_counts(r, PUBLIC_ROW_COUNTS)),
        RAW
        + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({PUBLIC_ROW_COUNTS[d]} AS BIGINT) AS expected_count FROM {t}"
            for d, t in KEY_TABLES.items()
        ),
    ),
    # --- staging -----------------------------------------------------------------
    "slv_provider": (
        over_staging(lambda s: s["stg_provider"]),
        RAW + STAGING + "SELECT * FROM stg_provider",
    ),
    "slv_provider_rejects": (
        lambda spark, sf_dir: silver.provider_rejects(raw(spark, sf_dir)["provider"]),
        RAW
        + """SELECT trim(Provider) AS provider_id, PotentialFraud AS label FROM raw_provider
        WHERE trim(PotentialFraud) NOT IN ('Yes', 'No')""",
    ),
    "slv_beneficiary": (
        over_staging(lambda s: s["stg_beneficiary"]),
        RAW + STAGING + "SELECT * FROM stg_beneficiary",
    ),
    "slv_claims_ip": (
        lambda spark, sf_dir: doubles(silver.inpatient_claims(raw(spark, sf_dir)["inpatient"])),
        RAW + STAGING + "SELECT * FROM stg_ip",
    ),
    "slv_claims_op": (
        lambda spark, sf_dir: doubles(silver.outpatient_claims(raw(spark, sf_dir)["outpatient"])),
        RAW + STAGING + "SELECT * FROM stg_op",
    ),
    "slv_age": (
        over_staging(lambda s: s["stg_beneficiary"].select("beneficiary_id", "date_of_birth", "patient_age")),
        RAW + STAGING + "SELECT beneficiary_id, date_of_birth, patient_age FROM stg_beneficiary",
    ),
    "slv_age_group": (
        over_staging(
            lambda s: s["stg_beneficiary"].groupBy("age_group").agg(
                F.count(F.lit(1)).alias("beneficiaries"),
                F.min("patient_age").alias("youngest"),
                F.max("patient_age").alias("oldest"),
            )
        ),
        RAW
        + STAGING
        + """SELECT age_group, count(*) AS beneficiaries, min(patient_age) AS youngest, max(patient_age) AS oldest
        FROM stg_beneficiary GROUP BY age_group""",
    ),
    "slv_code_count": (
        over_staging(
            lambda s: s["stg_claims"]
            .groupBy("claim_type", "diagnosis_code_count", "procedure_code_count")
            .agg(F.count(F.lit(1)).alias("claims"))
        ),
        RAW
        + STAGING
        + "SELECT claim_type, diagnosis_code_count, procedure_code_count, count(*) AS claims FROM stg_claims GROUP BY ALL",
    ),
    "slv_na_to_null": (
        over_staging(
            lambda s: s["stg_claims"].groupBy("claim_type").agg(
                *[
                    F.count_if(F.col(c).isNull()).alias(f"{c}_nulls")
                    for c in ("attending_physician_id", "operating_physician_id", "other_physician_id", "diagnosis_code_10", "procedure_code_1")
                ]
            )
        ),
        RAW
        + STAGING
        + "SELECT claim_type, "
        + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls"
            for c in ("attending_physician_id", "operating_physician_id", "other_physician_id", "diagnosis_code_10", "procedure_code_1")
        )
        + " FROM stg_claims GROUP BY claim_type",
    ),
    "slv_na_to_zero": (
        over_staging(
            lambda s: s["stg_claims"].groupBy("deductible_amt_paid").agg(F.count(F.lit(1)).alias("claims"))
        ),
        RAW
        + STAGING
        + "SELECT deductible_amt_paid, count(*) AS claims FROM stg_claims GROUP BY deductible_amt_paid",
    ),
    # --- gold --------------------------------------------------------------------
    "gld_dim_provider": (
        over_gold(lambda g: g["dim_provider"]),
        RAW + STAGING + GOLD + "SELECT * FROM dim_provider",
    ),
    "gld_dim_beneficiary": (
        over_gold(lambda g: g["dim_beneficiary"]),
        RAW + STAGING + GOLD + "SELECT * FROM dim_beneficiary",
    ),
    "gld_dim_date": (
        over_gold(lambda g: g["dim_date"]),
        RAW + STAGING + GOLD + "SELECT * FROM dim_date",
    ),
    "gld_dim_geography": (
        over_gold(
            lambda g: g["dim_geography"].join(
                g["fact_claims"].groupBy("geo_key").agg(F.count(F.lit(1)).alias("claims")),
                "geo_key",
                "left",
            )
        ),
        RAW
        + STAGING
        + GOLD
        + """SELECT * FROM dim_geography LEFT JOIN
        (SELECT geo_key, count(*) AS claims FROM fact_claims GROUP BY geo_key) USING (geo_key)""",
    ),
    "gld_fact": (
        over_gold(lambda g: g["fact_claims"]),
        RAW + STAGING + GOLD + "SELECT * FROM fact_claims",
    ),
    "gld_unmatched": (
        over_staging(
            lambda s: gold.unmatched_claims(s["stg_claims"], s["stg_provider"], s["stg_beneficiary"])
        ),
        RAW
        + STAGING
        + """, x AS (SELECT provider_id NOT IN (SELECT provider_id FROM stg_provider) AS np,
          beneficiary_id NOT IN (SELECT beneficiary_id FROM stg_beneficiary) AS nb FROM stg_claims)
        SELECT count(*) FILTER (WHERE np) AS no_provider, count(*) FILTER (WHERE nb) AS no_beneficiary,
          count(*) FILTER (WHERE np OR nb) AS dropped_claims FROM x""",
    ),
    "gld_agg_provider_text": (
        over_gold(lambda g: g["agg_provider_summary"]),
        RAW + STAGING + GOLD + "SELECT * FROM agg_provider_summary",
    ),
    "gld_agg_state_month_text": (
        over_gold(lambda g: g["agg_state_monthly"]),
        RAW + STAGING + GOLD + "SELECT * FROM agg_state_monthly",
    ),
    "gld_agg_disease_text": (
        over_gold(lambda g: g["agg_chronic_disease"]),
        RAW + STAGING + GOLD + "SELECT * FROM agg_chronic_disease",
    ),
    # --- gates -------------------------------------------------------------------
    "val_bronze": (
        lambda spark, sf_dir: checks.bronze(
            raw(spark, sf_dir)["inpatient"], "inpatient", PUBLIC_ROW_COUNTS["inpatient"]
        ),
        RAW + f"SELECT * FROM ({bronze_sql()}) WHERE check_name LIKE 'raw_inpatient%'",
    ),
    "val_bronze_all": (
        over_raw(lambda r: checks.bronze_all(r, PUBLIC_ROW_COUNTS)),
        RAW + bronze_sql(),
    ),
    "val_slv_counts": (
        over_staging(lambda s: checks.silver_counts(s, EXPECT.silver)),
        RAW + STAGING + counts_sql(SILVER_COUNT_ROWS, EXPECT.silver),
    ),
    "val_slv_nulls": (
        over_staging(checks.silver_nulls),
        RAW + STAGING + check_sql("silver", SILVER_NULLS),
    ),
    "val_slv_domains": (
        over_staging(checks.silver_domains),
        RAW + STAGING + check_sql("silver", SILVER_DOMAINS),
    ),
    "val_slv_distinct": (
        over_staging(checks.silver_distinct),
        RAW
        + STAGING
        + " UNION ALL ".join(
            f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {t}"
            for c, t in (
                ("is_potential_fraud", "stg_provider"),
                ("gender", "stg_beneficiary"),
                ("age_group", "stg_beneficiary"),
                ("claim_type", "stg_claims"),
                ("is_deceased", "stg_beneficiary"),
            )
        ),
    ),
    "val_slv_derived": (
        over_staging(checks.silver_derived),
        RAW + STAGING + check_sql("silver", SILVER_DERIVED),
    ),
    "val_slv_ri": (
        over_staging(checks.silver_references),
        RAW + STAGING + check_sql("silver", SILVER_REFS),
    ),
    "val_slv_na": (
        over_staging(checks.silver_placeholders),
        RAW + STAGING + check_sql("silver", SILVER_NA),
    ),
    "val_slv_ranges": (
        over_staging(checks.silver_ranges),
        RAW
        + STAGING
        + " UNION ALL ".join(
            [
                spread_sql("age", "stg_beneficiary", "patient_age", "patient_age < 0"),
                spread_sql("condition count", "stg_beneficiary", "chronic_condition_count", "chronic_condition_count NOT BETWEEN 0 AND 11"),
                spread_sql("claim duration", "stg_claims", "claim_duration_days", "claim_duration_days < 0"),
                spread_sql("inpatient duration", "stg_claims", "claim_duration_days", "claim_duration_days < 0", IP),
                spread_sql("inpatient amount", "stg_claims", AMT, f"{AMT} < 0", IP),
                spread_sql("outpatient amount", "stg_claims", AMT, f"{AMT} < 0", OP),
            ]
        ),
    ),
    "val_slv_business": (
        over_staging(checks.silver_business),
        RAW
        + STAGING
        + f"""SELECT 'fraud provider %' AS metric, 'all' AS item, CAST(count(*) FILTER (WHERE is_potential_fraud) AS DOUBLE) / count(*) * 100 AS value FROM stg_provider
        UNION ALL SELECT 'deceased beneficiary %', 'all', CAST(count(*) FILTER (WHERE is_deceased) AS DOUBLE) / count(*) * 100 FROM stg_beneficiary
        UNION ALL SELECT 'same-day discharges', 'all', CAST(count(*) FILTER (WHERE is_same_day_discharge) AS DOUBLE) FROM stg_ip
        UNION ALL SELECT 'zero reimbursement', claim_type, CAST(count(*) FILTER (WHERE is_zero_reimbursement) AS DOUBLE) FROM stg_claims GROUP BY claim_type
        UNION ALL {tiers_sql('stg_beneficiary')}""",
    ),
    "val_gld_counts": (
        over_gold(lambda g: checks.gold_counts(g, EXPECT.gold)),
        RAW + STAGING + GOLD + counts_sql(GOLD_COUNT_ROWS, EXPECT.gold),
    ),
    "val_gld_ri": (
        over_gold(checks.gold_references),
        RAW + STAGING + GOLD + check_sql("gold", GOLD_REFS),
    ),
    "val_gld_fact": (
        over_gold(checks.gold_fact),
        RAW + STAGING + GOLD + check_sql("gold", GOLD_FACT),
    ),
    "val_gld_fact_types": (
        over_gold(checks.gold_fact_types),
        RAW + STAGING + GOLD + "SELECT claim_type, count(*) AS row_count FROM fact_claims GROUP BY claim_type",
    ),
    "val_gld_dims": (
        over_gold(checks.gold_dims),
        RAW + STAGING + GOLD + check_sql("gold", GOLD_DIMS),
    ),
    "val_gld_agg": (
        over_gold(checks.gold_rollup),
        RAW
        + STAGING
        + GOLD
        + f"""SELECT 'gold' AS layer, check_name, issue_count, 'critical' AS severity, issue_count = 0 AS passed FROM (
        SELECT 'agg_provider_summary: amount differ from fact' AS check_name, CAST(abs((SELECT sum({AMT}) FROM fact_claims)
          - (SELECT sum(total_reimbursement) FROM agg_provider_summary)) AS BIGINT) AS issue_count
        UNION ALL SELECT 'agg_provider_summary: claims differ from fact', CAST(abs((SELECT count(*) FROM fact_claims)
          - (SELECT sum(total_claims) FROM agg_provider_summary)) AS BIGINT))""",
    ),
    "val_gld_kpi": (
        over_gold(checks.gold_kpis),
        RAW
        + STAGING
        + GOLD
        + f"""SELECT 'fraud provider %' AS metric, 'all' AS item, CAST(count(*) FILTER (WHERE is_potential_fraud) AS DOUBLE) / count(*) * 100 AS value FROM dim_provider
        UNION ALL SELECT 'claims', claim_type, CAST(count(*) AS DOUBLE) FROM fact_claims GROUP BY claim_type
        UNION ALL SELECT 'amount', claim_type, CAST(sum({AMT}) AS DOUBLE) FROM fact_claims GROUP BY claim_type
        UNION ALL SELECT 'average amount', claim_type, CAST(sum({AMT}) AS DOUBLE) / count({AMT}) FROM fact_claims GROUP BY claim_type
        UNION ALL {tiers_sql('dim_beneficiary')}
        UNION ALL SELECT 'states', region, CAST(count(DISTINCT state_code) AS DOUBLE) FROM dim_geography WHERE region <> 'Unknown' GROUP BY region
        UNION ALL SELECT 'first date key', 'all', CAST(min(date_key) AS DOUBLE) FROM dim_date
        UNION ALL SELECT 'last date key', 'all', CAST(max(date_key) AS DOUBLE) FROM dim_date
        UNION ALL SELECT 'calendar days', 'all', CAST(count(*) AS DOUBLE) FROM dim_date""",
    ),
    "val_gld_spot": (
        over_gold(checks.gold_spots),
        RAW
        + STAGING
        + GOLD
        + """SELECT * FROM (SELECT 'provider' AS spot, provider_id AS item, total_claims AS row_count, total_reimbursement
          FROM agg_provider_summary ORDER BY total_reimbursement DESC NULLS LAST, provider_id LIMIT 5)
        UNION ALL SELECT * FROM (SELECT 'state', state_name, CAST(sum(total_claims) AS BIGINT), CAST(sum(total_reimbursement) AS BIGINT) AS t
          FROM agg_state_monthly GROUP BY state_name ORDER BY t DESC NULLS LAST, state_name LIMIT 5)
        UNION ALL SELECT 'disease', disease_name, total_beneficiaries, total_reimbursement FROM agg_chronic_disease""",
    ),
}

# --- keys, rejects and business questions over a published batch -----------------------


def unique_sql(layer: str, table: str, key: str) -> str:
    return (
        f"SELECT '{layer}' AS layer, '{table}.{key}: not unique' AS check_name, "
        f"CAST(count(*) - count(DISTINCT {key}) - CASE WHEN count(*) > count({key}) THEN 1 ELSE 0 END AS BIGINT) "
        f"AS issue_count FROM {table}"
    )


def as_check_sql(parts: list[str]) -> str:
    return (
        "SELECT *, 'critical' AS severity, issue_count = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"
    )


SILVER_UNIQUE_SQL = [unique_sql("silver", t, k) for t, names in checks.SILVER_KEYS.items() for k in names]
GOLD_UNIQUE_SQL = [unique_sql("gold", t, k) for t, names in checks.GOLD_KEYS.items() for k in names]
REJECT_SQL = (
    f"SELECT 'bronze' AS layer, '{profile.NAMES['provider']}: unknown label' AS check_name, count(*) AS issue_count "
    f"FROM {KEY_TABLES['provider']} WHERE coalesce(trim(PotentialFraud), '') NOT IN ('Yes', 'No')"
)
PUBLISHED = GOLD + """
, c AS (SELECT f.*, p.provider_id, p.fraud_label, b.* EXCLUDE (beneficiary_key), g.state_name, g.state_abbr, g.region,
    CAST(strptime(CAST(claim_start_date_key AS VARCHAR), '%Y%m%d') AS DATE) AS claim_start_date,
    CAST(claim_start_date_key // 10000 AS INTEGER) AS year_num,
    CAST(claim_start_date_key // 100 % 100 AS INTEGER) AS month_num,
    monthname(strptime(CAST(claim_start_date_key AS VARCHAR), '%Y%m%d')) AS month_name,
    strftime(strptime(CAST(claim_start_date_key AS VARCHAR), '%Y%m%d'), '%Y-%m') AS year_month
  FROM fact_claims f JOIN dim_provider p USING (provider_key) JOIN dim_beneficiary b USING (beneficiary_key)
  LEFT JOIN dim_geography g ON g.geo_key = f.geo_key)
"""
AMOUNT_SQL = "CAST(coalesce(sum(claim_reimbursement_amt), 0) AS BIGINT)"
FRAUD_RATE_SQL = (
    "coalesce(CAST(count(DISTINCT provider_key) FILTER (WHERE is_potential_fraud) AS DOUBLE)"
    " / nullif(count(DISTINCT provider_key), 0), 0.0)"
)
SLICE = {"region": ["South", "West"], "claim_type": ["Outpatient"], "gender": ["Female"], "fraud_label": ["Not Fraud"]}


def asked(sql: str) -> str:
    """The SQL of a question over the published star."""
    return RAW + STAGING + PUBLISHED + sql


#: Business questions that are also asked of a published batch.
ASKED = [
    "exe_portfolio", "exe_ip_op_split", "exe_fraud_compare", "exe_top_states", "exe_alerts",
    "fin_cost_drivers", "fin_benchmark", "ops_state_mix", "rsk_watchlist", "rsk_tier_summary",
    "ops_kpis", "ops_los", "ops_duration_hist", "geo_state", "geo_fraud_density", "pop_high_utilizers",
]

def latest_of(dataset: str):
    return lambda spark, sf_dir: profile.latest(
        raw(spark, sf_dir)[dataset].withColumn("ingestion_timestamp", F.current_timestamp()), dataset
    ).drop("ingestion_timestamp")


def latest_sql(dataset: str) -> str:
    (key,) = PRIMARY_KEYS[dataset]
    others = [c for c in RAW_COLUMNS[dataset] if c != key]
    order = ", ".join([key, *(f"{c} NULLS LAST" for c in others)])
    return f"SELECT {', '.join(RAW_COLUMNS[dataset])} FROM {KEY_TABLES[dataset]} ORDER BY {order} LIMIT 5"


QUERIES |= {
    **{
        f"prf_latest_{dataset}": (latest_of(dataset), RAW + latest_sql(dataset))
        for dataset in ("provider", "inpatient", "outpatient")
    },
    "val_slv_unique": (
        over_staging(checks.silver_unique),
        RAW + STAGING + as_check_sql(SILVER_UNIQUE_SQL),
    ),
    "val_gld_unique": (
        over_gold(checks.gold_unique),
        RAW + STAGING + GOLD + as_check_sql(GOLD_UNIQUE_SQL),
    ),
    "pub_distinct_range": (
        over_published(lambda m: distinct.range_metrics(m, ["state_name"], months=(199502, 199704))),
        RAW
        + STAGING
        + PUBLISHED
        + f"""SELECT coalesce(state_name, 'Unmapped') AS state_name, {RANGE_COLUMNS} FROM c
        WHERE year_num * 100 + month_num BETWEEN 199502 AND 199704 GROUP BY 1""",
    ),
    "val_findings": (
        findings,
        RAW + STAGING + GOLD + as_check_sql([*SILVER_UNIQUE_SQL, *GOLD_UNIQUE_SQL, REJECT_SQL]),
    ),
    "pub_vis_drill": (
        over_published(reports.drill),
        asked(f"""SELECT fraud_label, claim_type, region, age_group,
          grouping(fraud_label, claim_type, region, age_group) AS grouping_level,
          count(*) AS total_claims, {AMOUNT_SQL} AS total_reimbursement
        FROM c GROUP BY CUBE (fraud_label, claim_type, region, age_group)"""),
    ),
    "pub_vis_filters": (
        over_published(lambda m: reports.sliced(m, SLICE)),
        asked(f"""SELECT year_num, month_num, count(*) AS total_claims, {AMOUNT_SQL} AS total_reimbursement,
          {FRAUD_RATE_SQL} AS fraud_rate,
          coalesce(CAST({AMOUNT_SQL} AS DOUBLE) / nullif(count(*), 0), 0.0) AS avg_reimbursement_per_claim
        FROM c WHERE region IN ('South', 'West') AND claim_type = 'Outpatient' AND gender = 'Female'
          AND fraud_label = 'Not Fraud' GROUP BY ALL"""),
    ),
    "pub_met_by_name": (
        over_published(lambda m: lattice.by_name(m, "Fraud Rate %", ["region", "year_month"])),
        asked(f"SELECT region, year_month, {FRAUD_RATE_SQL} AS selected_metric FROM c GROUP BY ALL"),
    ),
    **{
        f"pub_{name}": (
            over_published(business.QUERIES[name][0]),
            RAW + STAGING + PUBLISHED + business.QUERIES[name][1],
        )
        for name in ASKED
    },
}

ORACLES = {name: sql for name, (_, sql) in QUERIES.items()}
