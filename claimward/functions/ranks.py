"""Positions over whole tables without moving the table into one task.

A plain window without a partition sorts every row in a single task. Here equal keys are
first counted, the distinct keys are spread over range-ordered slices, every slice adds
up its own counts, and only the slice totals (one row per slice) are added up in one
place. A key shared by a third of all rows is one row after the counting step.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from claimward.session import materialize

Key = tuple[str, str]  # column name and "desc" or "asc"


def _ordering(keys: list[Key]) -> list[Column]:
    """Missing values count as the smallest, in both directions."""
    return [F.desc_nulls_last(c) if way == "desc" else F.asc_nulls_first(c) for c, way in keys]


def key_positions(df: DataFrame, keys: list[Key], totals: Sequence[str] = ()) -> DataFrame:
    """One row per distinct key: ``key_rows``, ``rows_before`` and ``keys_before``.

    For every column named in ``totals`` also its sum over the key's rows (``<name>_here``)
    and over all rows of earlier keys (``<name>_before``); a missing value adds nothing.
    """
    names = [name for name, _ in keys]
    order = _ordering(keys)
    here = [F.coalesce(F.sum(t), F.lit(0)).alias(f"{t}_here") for t in totals]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("key_rows"), *here)
    sliced = materialize(
        counted.repartitionByRange(*order).withColumn("slice_no", F.spark_partition_id())
    )
    earlier_slices = Window.orderBy("slice_no").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    offsets = (
        sliced.groupBy("slice_no")
        .agg(
            F.sum("key_rows").alias("slice_rows"),
            F.count(F.lit(1)).alias("slice_keys"),
            *[F.sum(f"{t}_here").alias(f"{t}_slice") for t in totals],
        )
        .select(
            "slice_no",
            F.coalesce(F.sum("slice_rows").over(earlier_slices), zero).alias("rows_offset"),
            F.coalesce(F.sum("slice_keys").over(earlier_slices), zero).alias("keys_offset"),
            *[
                F.coalesce(F.sum(f"{t}_slice").over(earlier_slices), F.lit(0)).alias(f"{t}_offset")
                for t in totals
            ],
        )
    )
    in_slice = Window.partitionBy("slice_no").orderBy(*order)
    earlier_keys = in_slice.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.join(F.broadcast(offsets), "slice_no")  # one row per shuffle partition
        .select(
            *names,
            "key_rows",
            (F.col("rows_offset") + F.coalesce(F.sum("key_rows").over(earlier_keys), zero)).alias(
                "rows_before"
            ),
            (F.col("keys_offset") + F.row_number().over(in_slice) - 1)
            .cast("bigint")
            .alias("keys_before"),
            *[f"{t}_here" for t in totals],
            *[
                (
                    F.col(f"{t}_offset")
                    + F.coalesce(F.sum(f"{t}_here").over(earlier_keys), F.lit(0))
                ).alias(f"{t}_before")
                for t in totals
            ],
        )
    )


def running_totals(df: DataFrame, keys: list[Key], totals: Sequence[str]) -> DataFrame:
    """``df`` with ``rows_up_to`` and ``<name>_up_to`` of every row.

    These are the rows and sums of all rows up to and with the row's own key, so rows with
    equal keys share them; name enough keys to tell rows apart.
    """
    positions = key_positions(df, keys, totals).select(
        *[F.col(name).alias(f"key_{i}") for i, (name, _) in enumerate(keys)],
        (F.col("rows_before") + F.col("key_rows")).alias("rows_up_to"),
        *[(F.col(f"{t}_before") + F.col(f"{t}_here")).alias(f"{t}_up_to") for t in totals],
    )
    return _joined_by_key(df, positions, keys)


def stepped_totals(
    df: DataFrame, key: Key, value: str, first: int, last: int, step: int
) -> DataFrame:
    """What the first ``n`` rows add up to, for every n = first, first + step, ... up to last.

    One row per n that the table reaches: ``n``, ``value_total`` and ``at_key``, the key of
    the nth row. ``value`` is a whole number, the same for all rows of a key (or the key).
    Every key finds the steps that fall on its own rows, so nothing is joined by range, and
    a key shared by many rows is one row.
    """
    positions = key_positions(df, [key], [value])
    start, end = F.lit(first).cast("bigint"), F.lit(last).cast("bigint")
    up_to = F.least(end, F.col("rows_before") + F.col("key_rows"))
    skipped = F.greatest(F.lit(0), F.ceil((F.col("rows_before") + 1 - start) / step)).cast("bigint")
    at = start + skipped * step
    each = F.expr(f"{value}_here div key_rows")
    return (
        positions.withColumn("from_n", at)
        .filter(F.col("from_n") <= up_to)
        .withColumn("n", F.explode(F.sequence(F.col("from_n"), up_to, F.lit(step).cast("bigint"))))
        .select(
            "n",
            (F.col(f"{value}_before") + (F.col("n") - F.col("rows_before")) * each).alias("value_total"),
            F.col(key[0]).alias("at_key"),
        )
    )


def _joined_by_key(df: DataFrame, by_key: DataFrame, keys: list[Key]) -> DataFrame:
    """Join rows with the columns of their key; ``by_key`` has the keys as key_0, key_1, ..."""
    same_key = reduce(
        lambda a, b: a & b,
        [df[name].eqNullSafe(by_key[f"key_{i}"]) for i, (name, _) in enumerate(keys)],
    )
    return df.join(by_key, same_key).drop(*[f"key_{i}" for i in range(len(keys))])


def with_rank(
    df: DataFrame,
    keys: list[Key],
    rank: str | None = None,
    dense: str | None = None,
    percent: str | None = None,
) -> DataFrame:
    """Add rank, dense rank and/or percent rank (0..1) over all rows of ``df``."""
    positions = key_positions(df, keys)
    added: dict[str, Column] = {}
    if rank:
        added[rank] = F.col("rows_before") + 1
    if dense:
        added[dense] = F.col("keys_before") + 1
    if percent:
        total = positions.agg(F.sum("key_rows")).scalar()
        added[percent] = F.coalesce(
            F.try_divide(F.col("rows_before").cast("double"), (total - 1).cast("double")),
            F.lit(0.0),
        )
    renamed = positions.select(
        *[F.col(name).alias(f"key_{i}") for i, (name, _) in enumerate(keys)],
        *[expr.alias(name) for name, expr in added.items()],
    )
    return _joined_by_key(df, renamed, keys)


def first_tile(df: DataFrame, value: str, tiles: int) -> DataFrame:
    """Rows, sum and mean of the first of ``tiles`` equal-sized groups by falling value.

    Rows with equal values are interchangeable here, so the counts per value suffice and
    no row has to be numbered.
    """
    positions = key_positions(df, [(value, "desc")])
    total = positions.agg(F.coalesce(F.sum("key_rows"), F.lit(0).cast("bigint"))).scalar()
    size = F.ceil(total / tiles)
    zero = F.lit(0).cast("bigint")
    taken = F.least(F.col("key_rows"), F.greatest(size - F.col("rows_before"), zero))
    return (
        positions.withColumn("taken", taken)
        .filter("taken > 0")
        .agg(
            F.coalesce(F.sum("taken"), zero).alias("tile_rows"),
            F.sum(F.col(value) * F.col("taken")).alias("tile_sum"),
            F.try_divide(
                F.sum(F.col(value) * F.col("taken")),
                F.sum(F.when(F.col(value).isNotNull(), F.col("taken"))),
            ).alias("tile_mean"),
        )
    )
