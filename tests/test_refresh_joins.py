"""The refresh joins claims and beneficiaries where they are stored side by side."""

import pytest
from pyspark.sql import functions as F

from claimward.catalog import intake
from claimward.operators import distinct
from claimward.plans import refresh
from claimward.sources import tables

SF_DIR = "/root/testdata/sf0.001"
MOVED = "hashpartitioning(beneficiary_key"


class Seen(Exception):
    pass


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def by_age(model):
    return model.joined("beneficiary").groupBy("age_group").agg(F.sum("claim_reimbursement_amt"))


@pytest.mark.parametrize("module, name", [(refresh.gold, "provider_rollup"), (refresh.lattice, "build")])
def test_rollups_and_sets_join_the_stored_pair(spark, tmp_path, monkeypatch, module, name):
    def look(model, *rest):
        assert model.colocated is not None
        made = plan(by_age(model))
        assert MOVED not in made and "Bucketed: true" in made
        raise Seen

    monkeypatch.setattr(module, name, look)
    with pytest.raises(Seen):
        refresh.refresh(
            spark, intake.raw(spark, SF_DIR), str(tmp_path / "w"), "20240101_000000", strict=False
        )


def test_claims_of_the_calendar_stay_beside_their_beneficiaries(spark):
    model = refresh.published_model(spark, intake.refreshed_root(spark, SF_DIR))
    keys = distinct.state_month_keys(refresh.in_calendar(model))
    assert MOVED not in plan(keys) and "Bucketed: true" in plan(keys)
    plain = distinct.state_month_keys(refresh.in_calendar(refresh.replace(model, colocated=None)))
    assert sorted(keys.collect(), key=str) == sorted(plain.collect(), key=str)


def test_claims_of_a_bucket_are_not_sorted(spark):
    model = refresh.published_model(spark, intake.refreshed_root(spark, SF_DIR))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = plan(by_age(model))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ShuffledHashJoin" in made and "SortMergeJoin" not in made


def test_digests_equal_the_sum_of_whole_hashes(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, cast(id as string)) as t")
    whole = F.xxhash64("id", "t", F.col("id").isNull(), F.col("t").isNull()).cast("decimal(20,0)")
    row = df.agg(tables.content_digest(["t", "id"]).alias("made"), F.sum(whole).cast("string").alias("plain"))
    assert row.filter("made <> plain").count() == 0
