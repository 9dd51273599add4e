"""Raw text files: everything is read as text, nothing is converted."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimward.schemas import AUDIT_COLUMNS, CORRUPT, DATASETS, RAW_COLUMNS, text_schema


def new_batch_id(now: dt.datetime | None = None) -> str:
    """One stamp per run, shared by all files of the run."""
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def read_text(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """One dataset from CSV files, columns as declared; a different header is an error.

    Records may hold quoted commas and doubled quotes. Files stay splittable, so a record
    must not span lines. Empty fields arrive as NULL, the text NA stays text.
    """
    return (
        spark.read.schema(text_schema(dataset))
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def with_audit(df: DataFrame, batch_id: str) -> DataFrame:
    """Load time, source file and batch of every row."""
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file_name": F.col("_metadata.file_name"),
            "batch_id": F.lit(batch_id),
        }
    )


def read_raw(spark: SparkSession, path: str, dataset: str, batch_id: str) -> DataFrame:
    audited = with_audit(read_text(spark, path, dataset), batch_id)
    return audited.select(*RAW_COLUMNS[dataset], *AUDIT_COLUMNS, CORRUPT)


def read_all(spark: SparkSession, paths: dict[str, str], batch_id: str) -> dict[str, DataFrame]:
    """Lazy frames for all four datasets under one batch id."""
    return {name: read_raw(spark, paths[name], name, batch_id) for name in DATASETS}


def source_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files and bytes per dataset; raises when any source is missing.

    Only the file listing is used, contents are not read.
    """
    found, missing = [], []
    for name in DATASETS:
        try:
            listing = spark.read.format("binaryFile").load(paths[name])
        except AnalysisException:
            missing.append(f"{name}: {paths[name]}")
            continue
        found.append(
            listing.agg(
                F.lit(name).alias("dataset"),
                F.count(F.lit(1)).alias("files"),
                F.coalesce(F.sum("length"), F.lit(0).cast("bigint")).alias("bytes"),
            )
        )
    if missing:
        raise FileNotFoundError("missing source files: " + "; ".join(missing))
    result = found[0]
    for other in found[1:]:
        result = result.unionByName(other)
    return result


def strip_quotes(raw_beneficiary: DataFrame) -> DataFrame:
    """Remove stray double quotes from the two columns known to carry them."""
    return raw_beneficiary.withColumns(
        {
            name: F.regexp_replace(name, '"', "")
            for name in ("BeneID", "RenalDiseaseIndicator")
        }
    )
