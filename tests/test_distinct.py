"""Mergeable key sets against plain sets."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from claimward.operators import distinct
from claimward.plans import refresh

SETS = {"a": "a", "b": "if(flag, b, null)"}


def test_sets_add_up_over_any_groups(spark):
    rng = random.Random(3)
    keys = [1, 2, 32768, 32769, 65536, 65537, 10_000_000, *range(500, 600)]
    rows = [
        (rng.choice("xyz"), rng.randrange(4), rng.choice([*keys, None]), rng.choice(keys), rng.random() < 0.3)
        for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "g string, m int, a bigint, b bigint, flag boolean").repartition(5)
    bitmaps = distinct.key_bitmaps(df, ["g", "m"], SETS)
    assert {len(r.keys) for r in bitmaps.collect()} == {4096}
    for by in ([], ["g"], ["m"], ["g", "m"]):
        found = distinct.distinct_counts(bitmaps, by, SETS).collect()
        for r in found:
            part = [x for x in rows if all(x[("g", "m").index(c)] == r[c] for c in by)]
            assert r.a == len({x[2] for x in part} - {None})
            assert r.b == len({x[3] for x in part if x[4]})
        assert len(found) == len({tuple(x[("g", "m").index(c)] for c in by) for x in rows})
    picked = distinct.distinct_counts(bitmaps.filter("m between 1 and 2 and g <> 'x'"), [], SETS).collect()[0]
    part = [x for x in rows if x[1] in (1, 2) and x[0] != "x"]
    assert (picked.a, picked.b) == (len({x[2] for x in part} - {None}), len({x[3] for x in part if x[4]}))


def test_bitmaps_are_made_where_their_keys_are(spark):
    """Tasks over rows in no order would each make a bitmap of 4 KB for nearly every row."""
    rows = spark.range(0, 6000, 1, 8).selectExpr("id % 1500 as g", "id * 7919 % 90000 as a", "id as b", "true as flag")
    bitmaps = distinct.key_bitmaps(rows, ["g"], SETS)
    sizes = bitmaps.groupBy("g", "set_name").agg(F.sum(F.bitmap_count("keys")).alias("n"))
    found = {(r.g, r.set_name): r.n for r in sizes.collect()}
    assert found == {(g, name): 4 for g in range(1500) for name in SETS}
    plan = bitmaps._jdf.queryExecution().executedPlan().toString()
    merged, made = plan.split("partial_bitmap_construct_agg")
    assert "Exchange" in merged and "REBALANCE_PARTITIONS_BY_COL" in made


def test_no_rows_and_unknown_columns(spark, star_model):
    empty = spark.createDataFrame([], "g string, a bigint, b bigint, flag boolean")
    bitmaps = distinct.key_bitmaps(empty, ["g"], SETS)
    assert distinct.distinct_counts(bitmaps, ["g"], SETS).count() == 0
    row = distinct.range_metrics(star_model, months=(100001, 100012)).collect()[0]
    assert (row.total_claims, row.unique_beneficiaries, row.fraud_rate) == (0, 0, 0.0)
    with pytest.raises(KeyError, match="grain"):
        distinct.range_metrics(star_model, ["provider_id"])


def test_windows_across_years(make_model):
    from conftest import day

    months = ["1995-11-03", "1995-12-09", "1996-02-01", "1996-02-20"]
    claims = [(f"c{i}", i % 2 + 1, i + 1, "Outpatient", day(d), 5, 1, 2) for i, d in enumerate(months)]
    people = {i + 1: {} for i in range(4)}
    model = make_model(claims, {1: True, 2: False}, people)
    found = {r.year_month: (r.unique_beneficiaries, r.unique_providers) for r in distinct.rolling_distinct(model).collect()}
    assert found == {"1995-11": (1, 1), "1995-12": (2, 2), "1996-02": (3, 2)}


@pytest.fixture(scope="module")
def published(spark):
    from claimward.catalog import intake

    return refresh.published_model(spark, intake.refreshed_root(spark, "/root/testdata/sf0.001"))


@pytest.mark.parametrize("by, months", list(product((["region"], ["year_num", "month_num"], []), (None, (199501, 199612)))))
def test_published_sets_answer_without_the_fact(published, by, months):
    df = distinct.range_metrics(published, by, {"region": ["South", "West"]}, months)
    files = df.inputFiles()
    assert files and not any("fact_claims" in f for f in files)
    assert not by or any(distinct.KEY_ROLLUP in f for f in files)  # a subquery's files are not listed
    bare = published.__class__(published.fact, published.providers, published.beneficiaries, published.geography)
    direct = distinct.range_metrics(bare, by, {"region": ["South", "West"]}, months or (190001, 209912))
    key = lambda r: tuple(map(str, r))
    assert sorted(df.collect(), key=key) == sorted(direct.collect(), key=key)


def test_state_rollup_takes_its_counts_from_the_key_sets(spark, star_model):
    """Equal rows, and claims are not repeated once per distinct count."""
    from claimward.operators import gold

    keys = distinct.state_month_keys(star_model)
    counted = distinct.distinct_counts(keys, distinct.GRAIN, distinct.SETS)
    rollup = gold.state_month_rollup(star_model, counted)
    plain = gold.state_month_rollup(star_model)
    assert rollup.dtypes == plain.dtypes
    assert sorted(map(str, rollup.collect())) == sorted(map(str, plain.collect()))
    assert "Expand" not in rollup._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_provider_and_patient_move_without_measures(spark, star_model):
    from claimward.operators import gold

    stored = {"agg_provider_summary": gold.provider_rollup(star_model)}
    fact = star_model.fact.drop("attending_physician_id")
    model = distinct.ClaimsModel(fact, star_model.providers, star_model.beneficiaries, star_model.geography, stored)
    rollup = gold.provider_rollup(model)
    assert rollup.select(*stored["agg_provider_summary"].columns).exceptAll(stored["agg_provider_summary"]).count() == 0
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    pairs = [line for line in plan.split("\n") if "keys=[provider_key" in line and "beneficiary_key" in line.split("functions")[0]]
    assert pairs and all("functions=[]" in line for line in pairs)
