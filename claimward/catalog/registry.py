"""All registered queries in one place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimward.catalog import business, intake, metric_queries
from claimward.sources import star

Query = Callable[[SparkSession, str], DataFrame]


def _over_model(function) -> Query:
    return lambda spark, sf_dir: function(star.model(spark, sf_dir))


def queries() -> dict[str, Query]:
    modelled = {**business.QUERIES, **metric_queries.QUERIES}
    typed = {name: _over_model(function) for name, (function, _) in modelled.items()}
    return {**typed, **{name: query for name, (query, _) in intake.QUERIES.items()}}


def oracle_sql() -> dict[str, str]:
    return {**business.ORACLES, **metric_queries.ORACLES, **intake.ORACLES}
