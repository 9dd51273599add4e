"""Claims and beneficiaries stored for joins without an exchange."""

import pytest
from pyspark.sql import functions as F

from claimward.catalog import business, intake
from claimward.operators import colocation
from claimward.operators.metrics import metrics
from claimward.operators.tally import ValidationError
from claimward.plans import refresh
from claimward.sources import tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark):
    return intake.refreshed_root(spark, SF_DIR)


@pytest.fixture
def no_broadcast(spark):
    """Plans as for a dimension too large to be sent to every task."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def digest(df):
    return df.agg(F.count(F.lit(1)).alias("n"), tables.content_digest(df.columns).alias("d")).first()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bare(model):
    return refresh.replace(model, colocated=None)


def test_join_moves_no_claim(spark, root, no_broadcast):
    model = refresh.published_model(spark, root)
    by_age = [F.count(F.lit(1)).alias("n"), F.sum("claim_reimbursement_amt").alias("amount")]
    moved = "hashpartitioning(beneficiary_key"
    stored = model.joined("beneficiary").groupBy("age_group").agg(*by_age)
    plain = bare(model).joined("beneficiary").groupBy("age_group").agg(*by_age)
    assert moved in plan(plain) and moved not in plan(stored)
    assert "Bucketed: true" in plan(stored)
    assert sorted(stored.collect()) == sorted(plain.collect())
    states = model.joined("beneficiary", "state", "provider").groupBy("state_name").agg(*by_age)
    assert moved not in plan(states)


def test_rows_equal_the_plain_join(spark, root):
    model = refresh.published_model(spark, root)
    for parts in (("beneficiary",), ("provider", "beneficiary"), ("beneficiary", "state", "provider")):
        stored, plain = model.joined(*parts), bare(model).joined(*parts)
        assert set(stored.columns) == set(plain.columns), parts
        assert digest(stored) == digest(plain.select(stored.columns)), parts


@pytest.mark.parametrize("name", ["exe_portfolio", "pop_disease_burden", "geo_state", "rsk_watchlist"])
def test_questions_agree(spark, root, name):
    model = refresh.published_model(spark, root)
    function = business.QUERIES[name][0]
    assert digest(function(model)) == digest(function(bare(model)))


def test_filters_on_months_skip_files(spark, root):
    model = refresh.published_model(spark, root)
    wanted = {"year_num": [1996], "month_num": [1], "gender": ["Female"]}
    df = metrics(model, ["total_claims"], filters=wanted)
    # the scan of the bucketed claims; no beneficiary of these tables is hot, so nothing lies beside it
    scans = [s for s in plan(df).splitlines() if "FileScan" in s and "default.claimward_" in s and "claim_month" in s]
    assert scans and all("PartitionFilters: [isnotnull(claim_month" in s for s in scans), scans
    assert df.collect() == metrics(bare(model), ["total_claims"], filters=wanted).collect()


def test_a_session_that_has_not_declared_the_table_reads_it(spark, root, no_broadcast):
    entries = tables.current(spark, root).filter("buckets > 0").collect()
    assert {e.table_name for e in entries} == {colocation.CLAIMS, colocation.PEOPLE}
    for e in entries:
        layout = (e.columns, e.partition_key, e.bucket_key, e.buckets)
        name = tables.declare_buckets(spark, e.path, *layout)
        spark.sql(f"DROP TABLE {name}")  # files stay: the table lies at a given place
        assert tables.stored_frame(spark, e).count() == e.table_rows
        assert "Bucketed: true" in plan(tables.stored_frame(spark, e).groupBy(colocation.KEY).count())


def stored_in(spark, root):
    def keep(made, buckets):
        done = {}
        for name, df in made.items():
            month = "claim_month" if "claim_month" in df.columns else None
            staged = tables.stage(df, root, "colocated", name, "b", month, buckets=buckets)
            done[name] = tables.staged_frame(spark, staged)
        return done

    return keep


def claims_of(spark, keys):
    rows = [(f"C{i}", key, 20240101 + i % 28, 202401 + i % 2) for i, key in enumerate(keys)]
    layout = "claim_id string, beneficiary_key bigint, claim_start_date_key int, claim_month int"
    return spark.createDataFrame(rows, layout)


def people_of(spark, count):
    return spark.range(1, count + 1).select(F.col("id").alias("beneficiary_key"), F.lit("x").alias("gender"))


def test_a_key_with_a_third_of_all_rows_is_kept_apart(spark, tmp_path):
    keys = [7] * 200 + [1 + i % 90 for i in range(400)]
    fact, people = claims_of(spark, keys), people_of(spark, 90)
    made = colocation.build(fact, people, len(keys), 8, stored_in(spark, str(tmp_path)))
    assert [r.beneficiary_key for r in made[colocation.HOT_PEOPLE].collect()] == [7]
    assert made[colocation.HOT_CLAIMS].count() == keys.count(7)
    assert made[colocation.CLAIMS].filter("beneficiary_key = 7").count() == 0
    stored = colocation.colocated(made).joined()
    plain = fact.join(people, "beneficiary_key")
    assert digest(stored.select(plain.columns)) == digest(plain)


@pytest.mark.parametrize("keys", [[], [1], [1, 2, 3, 4], [5] * 30, [1, 1, 99, None]])
def test_small_equal_and_unmatched_keys(spark, tmp_path, keys):
    """No claims, one claim, equal counts, one key only, keys without a beneficiary."""
    fact, people = claims_of(spark, keys), people_of(spark, 6)
    made = colocation.build(fact, people, len(keys), 3, stored_in(spark, str(tmp_path)))
    assert made[colocation.HOT_PEOPLE].count() < 3
    both = made[colocation.CLAIMS].unionByName(made[colocation.HOT_CLAIMS])
    assert digest(both) == digest(fact)
    plain = fact.join(people, "beneficiary_key")
    assert digest(colocation.colocated(made).joined().select(plain.columns)) == digest(plain)


def test_buckets_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert colocation.bucket_number(spark, 0) == cores
    assert colocation.bucket_number(spark, 1000 * cores + 1, 1000) == cores + 1


def test_a_lost_claim_stops_the_refresh(spark, root, tmp_path, monkeypatch):
    build = colocation.build

    def losing(fact, *rest):
        return build(fact.filter("claim_reimbursement_amt > 0"), *rest)

    monkeypatch.setattr(colocation, "build", losing)
    with pytest.raises(ValidationError, match="differ from fact_claims"):
        refresh.refresh(
            spark, intake.raw(spark, SF_DIR), str(tmp_path / "w"), "20240101_000000", strict=False
        )
    assert tables.latest_version(spark, str(tmp_path / "w")) == 0
