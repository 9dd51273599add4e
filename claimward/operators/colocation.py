"""Claims and beneficiaries stored so that their join needs no exchange.

Both tables lie in the same number of buckets of the beneficiary key; the claims also lie in
partitions by month, so filters on months skip files. A bucket is one task, which a hot key
would overfill. Keys with more claims than an average bucket holds are
therefore stored apart; there are always fewer of them than buckets, whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimward.model import Colocated
from claimward.sources.tables import Buckets

KEY = "beneficiary_key"
LAYER = "colocated"
#: The gold tables of these names in another layout, and the hot keys' rows.
CLAIMS, PEOPLE = "fact_claims", "dim_beneficiary"
HOT_CLAIMS, HOT_PEOPLE = "fact_claims_hot", "dim_beneficiary_hot"

#: Claims, or beneficiaries where they are more, that one task is meant to join. The
#: beneficiaries of a bucket are held in memory, the claims pass by.
BUCKET_ROWS = 1 << 22


def bucket_number(spark: SparkSession, rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets for a table: as many as its rows need, and at least one a core of the cluster."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // bucket_rows))


def hot_keys(fact: DataFrame, rows: int, buckets: int) -> DataFrame:
    """Keys with more rows than an average bucket: fewer than ``buckets``."""
    counted = fact.groupBy(KEY).agg(F.count(F.lit(1)).alias("key_rows"))
    return counted.filter(F.col("key_rows") * buckets > rows).select(KEY)


def build(
    fact: DataFrame,
    people: DataFrame,
    rows: int,
    buckets: int,
    keep: Callable[[dict[str, DataFrame], Buckets | None], dict[str, DataFrame]],
) -> dict[str, DataFrame]:
    """The four tables; ``keep`` stores tables and returns them as stored.

    The hot keys are stored first, with their beneficiaries, and split the claims from there,
    so both halves of the claims see the same keys. Claims without a key are with the others.
    """
    hot = keep({HOT_PEOPLE: people.join(hot_keys(fact, rows, buckets), KEY, "left_semi")}, None)
    keys = F.broadcast(hot[HOT_PEOPLE].select(KEY))
    spread = keep({HOT_CLAIMS: fact.join(keys, KEY, "left_semi")}, None)
    by_claim = keep({CLAIMS: fact.join(keys, KEY, "left_anti")}, Buckets(KEY, buckets))
    return {**hot, **spread, **by_claim, **keep({PEOPLE: people}, Buckets(KEY, buckets))}


def colocated(stored: Mapping[str, DataFrame]) -> Colocated | None:
    """The stored pair, None where a version was published without it."""
    if not {CLAIMS, PEOPLE, HOT_CLAIMS, HOT_PEOPLE} <= set(stored):
        return None
    return Colocated(stored[CLAIMS], stored[PEOPLE], stored[HOT_CLAIMS], stored[HOT_PEOPLE])
