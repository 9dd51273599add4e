"""From raw documents to token files in five stages.

Each stage takes the documents its predecessor kept and returns documents with all their
columns; the last one writes id files and returns one row per document in them. ``run``
writes every stage's result to the shared folder and reads it back for the next.

Stages hold no state of their own. A document without an id passes every filter on its own
text; a repeated row survives the near-duplicate stage once; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimward.llm import decontaminate, minhash, mixing, quality, tokens
from claimward.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose quality score is below the threshold."""
    return quality.good_only(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that shares 80 % of its five-word shingles."""
    return minhash.deduplicated(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or sample documents until sources have their target weights."""
    return mixing.mix(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and return what a reader finds in them."""
    return tokens.encoded(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("source_mixing", mix_sources),
    ("token_ids", write_ids),
]

#: Trained models, seeded sampling and tokenization are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
