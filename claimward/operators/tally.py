"""One aggregate per table, unfolded into one row per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

CRITICAL, WARNING = "critical", "warning"
Check = tuple[str, Column, str]  # name, condition of a bad row, severity


class ValidationError(Exception):
    """At least one critical check found issues."""


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def measured(df: DataFrame, rows: list[tuple[str, dict[str, Column]]], label: str) -> DataFrame:
    """Rows of named aggregates computed together in one pass over ``df``.

    Every row gives the same set of columns; ``label`` names the column with the row name.
    """
    wanted, slots = {}, []
    for place, (name, columns) in enumerate(rows):
        fields = [F.lit(name).alias(label)]
        for column, aggregate in columns.items():
            wanted[f"m{place}_{column}"] = aggregate
            fields.append(F.col(f"m{place}_{column}").alias(column))
        slots.append(F.struct(*fields))
    one = df.agg(*[aggregate.alias(name) for name, aggregate in wanted.items()])
    return one.select(F.inline(F.array(*slots)))


def as_checks(counts: DataFrame, layer: str, severity: str | Column) -> DataFrame:
    """The uniform result from (check_name, issue_count) rows."""
    level = F.lit(severity) if isinstance(severity, str) else severity
    return counts.select(
        F.lit(layer).alias("layer"),
        "check_name",
        F.col("issue_count").cast("bigint").alias("issue_count"),
        level.alias("severity"),
        (F.coalesce("issue_count", F.lit(0)) == 0).alias("passed"),
    )


def tally(df: DataFrame, layer: str, checks: list[Check]) -> DataFrame:
    """Count the bad rows of every check in one pass."""
    counts = measured(
        df, [(name, {"issue_count": F.count_if(bad)}) for name, bad, _ in checks], "check_name"
    )
    levels = [F.lit(part) for name, _, level in checks for part in (name, level)]
    return as_checks(counts, layer, F.create_map(*levels)[F.col("check_name")])


def orphan_rows(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose key has no parent, as one count.

    Child rows are counted per key first, so a key with a third of all rows is one row in
    the join.
    """
    per_key = child.groupBy(F.col(key).alias("the_key")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias("the_key")).distinct()
    missing = per_key.join(known, "the_key", "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("issue_count"))


def named_count(counts: DataFrame, name: str) -> DataFrame:
    return counts.select(F.lit(name).alias("check_name"), "issue_count")


def require(rows: list[Row]) -> None:
    """Raise when a critical check among the rows failed."""
    failed = [row for row in rows if row.severity == CRITICAL and not row.passed]
    if failed:
        lines = [f"{row.layer}: {row.check_name} ({row.issue_count})" for row in failed]
        raise ValidationError("critical checks failed:\n" + "\n".join(lines))


def enforce(checks: DataFrame) -> DataFrame:
    """Raise when a critical check failed (the result has one row per check)."""
    require(checks.collect())
    return checks
