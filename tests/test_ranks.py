import random

import pytest

from claimward.functions.ranks import (
    first_tile,
    key_positions,
    running_totals,
    stepped_totals,
    with_rank,
)


def brute_force(values):
    """Rank, dense rank and percent rank by falling value, missing values last."""
    order = sorted(values, key=lambda v: (v is None, -(v or 0)))
    distinct = list(dict.fromkeys(order))
    n = len(order)
    return {
        v: (order.index(v) + 1, distinct.index(v) + 1, order.index(v) / (n - 1)) for v in distinct
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_match_brute_force_with_a_hot_value_and_nulls(spark, seed):
    rng = random.Random(seed)
    values = [0] * 100 + [None] * 5 + [rng.randrange(1, 60) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(4)
    ranked = with_rank(df, [("v", "desc")], rank="r", dense="d", percent="p").collect()
    assert len(ranked) == len(values)
    expected = brute_force(values)
    for row in ranked:
        assert (row.r, row.d) == expected[row.v][:2]
        assert row.p == pytest.approx(expected[row.v][2])


def test_rank_over_several_slices(spark):
    """Without merging of small partitions the offsets of many slices are exercised."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).selectExpr("id", "id % 97 as a", "id % 7 as b")
        rows = with_rank(df, [("a", "desc"), ("b", "asc")], rank="r").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    keys = sorted((-(i % 97), i % 7) for i in range(1000))
    assert {row.id: row.r for row in rows} == {
        i: keys.index((-(i % 97), i % 7)) + 1 for i in range(1000)
    }


def test_dense_rank_of_unique_text_numbers_rows(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    rows = with_rank(df, [("k", "asc")], dense="key").collect()
    assert {r.k: r.key for r in rows} == {"a": 1, "b": 2, "c": 3}


@pytest.mark.parametrize("n", [1, 9, 10, 11, 95, 104])
def test_first_tile_is_the_first_ntile(spark, n):
    values = sorted([(i * 7) % 13 for i in range(n)], reverse=True)
    size = n // 10 + (1 if n % 10 else 0)
    row = first_tile(spark.createDataFrame([(v,) for v in values], "v bigint"), "v", 10).collect()[0]
    assert row.tile_rows == size
    assert row.tile_sum == sum(values[:size])
    assert row.tile_mean == pytest.approx(sum(values[:size]) / size)


@pytest.mark.parametrize("merge", ["true", "false"])
def test_running_totals_match_brute_force(spark, merge):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, 5, 5, rng.randrange(40)]), rng.choice([None, rng.randrange(9)])) for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
    try:
        df = spark.createDataFrame(rows, "id int, v int, w bigint").repartition(4)
        found = {r.id: r for r in running_totals(df, [("v", "desc"), ("id", "asc")], ["w"]).collect()}
        by_v = key_positions(df, [("v", "desc")], ["w"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    so_far = 0
    ordered = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    for place, (key, _, w) in enumerate(ordered, 1):
        so_far += w or 0
        assert (found[key].rows_up_to, found[key].w_up_to) == (place, so_far)
    for r in by_v:
        earlier = [w or 0 for _, v, w in rows if r.v is None and v is not None or r.v is not None and v is not None and v > r.v]
        assert r.w_before == sum(earlier) and r.rows_before == len(earlier)


@pytest.mark.parametrize("series", [(1, 30, 1), (5, 60, 5), (7, 7, 3), (50, 500, 100), (2, 301, 299)])
def test_stepped_totals_match_brute_force(spark, series):
    rng = random.Random(11)
    values = [8] * 100 + [rng.randrange(50) for _ in range(200)]
    df = spark.createDataFrame([(v, v) for v in values], "k bigint, v bigint").repartition(4)
    found = {r.n: (r.value_total, r.at_key) for r in stepped_totals(df, ("k", "desc"), "v", *series).collect()}
    ordered = sorted(values, reverse=True)
    first, last, step = series
    assert found == {n: (sum(ordered[:n]), ordered[n - 1]) for n in range(first, last + 1, step) if n <= 300}
