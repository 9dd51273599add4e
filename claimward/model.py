"""The star that all business queries read."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from claimward.functions.columns import date_key

MONTH = ["year_num", "month_num", "month_name", "year_month"]
MONTH_KEY = ["year_num", "month_num"]
PROVIDER = ["provider_id", "fraud_label", "is_potential_fraud"]
STATE = ["state_name", "state_abbr", "region"]


@dataclass(frozen=True)
class Colocated:
    """The claims stored a second time, for joins with their beneficiaries.

    ``claims`` and ``people`` lie in the same buckets of the beneficiary, so their join moves
    no row. Claims of beneficiaries that would overfill a bucket are kept apart, in
    ``hot_claims``, spread over files; these beneficiaries are fewer than there are buckets,
    so ``hot_people`` can be sent to every task. A bucket's ``people`` are looked up by hash,
    so its claims need not be sorted.
    """

    claims: DataFrame
    people: DataFrame
    hot_claims: DataFrame
    hot_people: DataFrame

    def joined(self) -> DataFrame:
        rest = self.claims.join(self.people.hint("shuffle_hash"), "beneficiary_key")
        hot = self.hot_claims.join(F.broadcast(self.hot_people), "beneficiary_key")
        return with_start_date(rest.unionByName(hot))


@dataclass(frozen=True)
class ClaimsModel:
    """Claims and their dimensions, kept apart.

    Inner joins are never pruned, so a query names the dimensions it reads: ``fact`` alone,
    ``joined("provider", "state")``, or ``claims_with(names)`` for columns chosen at run
    time. Every fact row has its provider and beneficiary (the gold gate sees to that), so
    leaving a join out does not change the rows. ``rollups`` holds stored rollups by name,
    ``rollup_rows`` their row counts where known, ``calendar`` the stored days, ``colocated``
    the claims and beneficiaries as stored for joins between them.
    """

    fact: DataFrame
    providers: DataFrame
    beneficiaries: DataFrame
    geography: DataFrame
    rollups: dict[str, DataFrame] = field(default_factory=dict)
    calendar: DataFrame | None = None
    rollup_rows: dict[str, int] = field(default_factory=dict)
    colocated: Colocated | None = None

    def joined(self, *parts: str) -> DataFrame:
        """The claims with the named dimensions: provider, beneficiary, state."""
        unknown = set(parts) - {"provider", "beneficiary", "state"}
        if unknown:
            raise ValueError(f"unknown dimensions {sorted(unknown)}")
        rows = self.fact
        with_people = "beneficiary" in parts and self.colocated is not None
        if with_people:
            rows = self.colocated.joined()
        if "provider" in parts:
            both = [c for c in self.providers.columns if c in rows.columns and c != "provider_key"]
            rows = rows.join(self.providers.drop(*both), "provider_key")
        if "beneficiary" in parts and not with_people:
            rows = rows.join(self.beneficiaries, "beneficiary_key")
        if "state" in parts:
            if "geo_key" in rows.columns:
                states = self.geography.drop("state_code") if "state_code" in rows.columns else self.geography
                return rows.join(states, "geo_key", "left")
            if "state_code" not in rows.columns:
                home = self.beneficiaries.select("beneficiary_key", "state_code")
                rows = rows.join(home, "beneficiary_key")
            rows = rows.join(self.geography, "state_code", "left")
        return rows

    def claims_with(self, names: Iterable[str]) -> DataFrame:
        """The claims with those dimensions that hold any of the named columns."""
        missing = set(names) - set(self.fact.columns)
        parts = []
        if missing & set(self.providers.columns):
            parts.append("provider")
        if missing & set(self.beneficiaries.columns):
            parts.append("beneficiary")
        if missing & {*STATE, "geo_key"}:
            parts.append("state")
        return self.joined(*parts)

    @property
    def claims(self) -> DataFrame:
        """The claims with every dimension."""
        return self.joined("provider", "beneficiary", "state")


def with_month(df: DataFrame) -> DataFrame:
    """Year and month numbers: from the partition column where the fact is stored by month,
    so that filters on them skip files, else from the start date."""
    if "claim_month" in df.columns:
        year, month = F.expr("claim_month div 100"), F.expr("claim_month % 100")
    else:
        year, month = F.year("claim_start_date"), F.month("claim_start_date")
    return df.withColumns({"year_num": year.cast("int"), "month_num": month.cast("int")})


def name_months(df: DataFrame) -> DataFrame:
    """Month names on rows that are already grouped by year and month."""
    first = F.make_date("year_num", "month_num", F.lit(1))
    return df.withColumns(
        {"month_name": F.date_format(first, "MMMM"), "year_month": F.date_format(first, "yyyy-MM")}
    )


def with_start_date(fact: DataFrame) -> DataFrame:
    return fact.withColumn(
        "claim_start_date", F.to_date(F.col("claim_start_date_key").cast("string"), "yyyyMMdd")
    )


def model_from_gold(tables: dict[str, DataFrame]) -> ClaimsModel:
    """The model over stored gold tables, joined by surrogate key."""
    return ClaimsModel(
        with_start_date(tables["fact_claims"]),
        tables["dim_provider"],
        tables["dim_beneficiary"],
        tables["dim_geography"],
        {name: df for name, df in tables.items() if name.startswith("agg_")},
        tables.get("dim_date"),
    )


__all__ = [
    "ClaimsModel",
    "Colocated",
    "MONTH",
    "MONTH_KEY",
    "PROVIDER",
    "STATE",
    "date_key",
    "model_from_gold",
    "name_months",
    "with_month",
    "with_start_date",
]
