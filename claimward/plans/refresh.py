"""The full refresh: raw text to a published star, with a gate after every layer."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimward.config import Expectations
from claimward.model import ClaimsModel, Colocated, model_from_gold
from claimward.operators import checks, colocation, distinct, gold, lattice, silver
from claimward.operators.tally import ValidationError, require
from claimward.schemas import DATASETS
from claimward.sources import lookups, tables
from claimward.sources.text import new_batch_id, read_all, source_sizes, strip_quotes

MONTH_PARTITION = "claim_month"
FINDINGS = "layer string, check_name string, issue_count bigint, severity string, passed boolean"


@dataclass(frozen=True)
class RefreshResult:
    batch_id: str
    counts: DataFrame
    findings: DataFrame
    #: Layers taken from an earlier run of the batch.
    taken_up: tuple[str, ...] = ()


class OnDemand(Mapping):
    """Tables built when first asked for; a builder gets the mapping itself."""

    def __init__(self, builders: dict[str, Callable[[Mapping], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self)
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


STAR = ("dim_provider", "dim_beneficiary", "dim_date", "dim_geography", "fact_claims")


def gold_from_silver(
    spark: SparkSession, stg: dict[str, DataFrame], period: tuple[str, str] | None = None
) -> Mapping[str, DataFrame]:
    """The eight gold tables over staging tables, each built only if it is read.

    Building a dimension numbers its keys, which starts jobs.
    """

    def fact(t: Mapping) -> DataFrame:
        return gold.fact_claims(
            stg["stg_claims"], t["dim_provider"], t["dim_beneficiary"], t["dim_geography"]
        )

    def rollup(name: str) -> Callable[[Mapping], DataFrame]:
        return lambda t: ROLLUPS[name](model_from_gold({k: t[k] for k in STAR}), stg["stg_claims"])

    return OnDemand(
        {
            "dim_provider": lambda t: gold.dim_provider(stg["stg_provider"]),
            "dim_beneficiary": lambda t: gold.dim_beneficiary(stg["stg_beneficiary"]),
            "dim_date": lambda t: calendar(spark, stg["stg_claims"], period),
            "dim_geography": lambda t: lookups.states(spark),
            "fact_claims": fact,
            **{name: rollup(name) for name in ROLLUPS},
        }
    )


def calendar(spark: SparkSession, stg_claims: DataFrame, period: tuple[str, str] | None) -> DataFrame:
    """The declared days; without a declaration the days that the claims span."""
    return lookups.calendar(spark, *period) if period else lookups.calendar_over(stg_claims)


ROLLUPS: dict[str, Callable[[ClaimsModel, DataFrame], DataFrame]] = {
    "agg_provider_summary": lambda model, stg: gold.provider_rollup(model, stg),
    "agg_state_monthly": lambda model, stg: gold.state_month_rollup(in_calendar(model)),
    "agg_chronic_disease": lambda model, stg: gold.disease_rollup(model),
}


def in_calendar(model: ClaimsModel) -> ClaimsModel:
    """Claims whose start date is a day of the calendar; only those belong to a month."""
    days = model.calendar.select(F.col("date_key").alias("claim_start_date_key"))

    def dated(claims: DataFrame) -> DataFrame:
        return claims.join(days, "claim_start_date_key", "left_semi")

    pair = model.colocated
    if pair is not None:
        pair = replace(pair, claims=dated(pair.claims), hot_claims=dated(pair.hot_claims))
    return ClaimsModel(
        dated(model.fact), model.providers, model.beneficiaries, model.geography, colocated=pair
    )


def _require_match(report: DataFrame) -> None:
    wrong = report.filter(~F.col("matched")).collect()  # one row per table
    if wrong:
        lines = [f"{r.table_name}: {r.rows_written} rows, expected {r.expected_rows}" for r in wrong]
        raise ValidationError("row counts do not match:\n" + "\n".join(lines))


def _sources_digest(spark: SparkSession, paths: dict[str, str]) -> str:
    """Digest of the listing of all source files: names, sizes and times, not contents."""
    listed = []
    for name in DATASETS:
        files = spark.read.format("binaryFile").load(paths[name])
        one = files.select(F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)").alias("h"))
        listed.append([name, str(one.agg(F.sum("h")).first()[0])])
    return json.dumps(listed)


class Layers:
    """The layers of one batch, stored one after the other.

    A layer that passed its gate leaves a manifest: its tables with their content digests,
    its findings, the terms it passed under and the digest of the layer before. A refresh
    that takes a batch up again uses a stored layer if source, terms and the layer before are
    the same and its files still have their digests; from the first that does not fit on,
    layers are made anew.
    """

    def __init__(self, spark: SparkSession, root: str, batch: str, source: str | None, strict: bool, resume: bool):
        self.spark, self.root, self.batch, self.strict = spark, root, batch, strict
        self.source = source or ""
        self.attempt = tables.next_attempt(spark, root, batch) if resume else 0
        tables.claim_batch(spark, root, batch, self.attempt)
        self.base = tables.latest_version(spark, root)
        begun = tables.manifests(spark, root, batch, "bronze") if self.attempt else []
        if begun and begun[0]["base"] != self.base:
            raise tables.PublishConflict(f"batch {batch} is behind: version {self.base} was published since")
        self.staged: list[tables.Staged] = []
        self.found: list[tuple] = []
        self.taken: list[str] = []
        self._before = ""
        self._fits = self.attempt > 0

    def keep(
        self, layer: str, frames: dict[str, DataFrame], buckets: tables.Buckets | None = None
    ) -> dict[str, DataFrame]:
        stored = {}
        for name, df in frames.items():
            by = MONTH_PARTITION if MONTH_PARTITION in df.columns else None
            done = tables.stage(df, self.root, layer, name, self.batch, by, self.attempt, buckets)
            self.staged.append(done)
            stored[name] = tables.staged_frame(self.spark, done)
        return stored

    def frames(self, layer: str) -> dict[str, DataFrame]:
        """The tables staged for a layer, as stored."""
        return {s.name: tables.staged_frame(self.spark, s) for s in self.staged if s.layer == layer}

    def staged_as(self, layer: str, name: str) -> tables.Staged:
        return next(s for s in self.staged if (s.layer, s.name) == (layer, name))

    def gate(self, checked: DataFrame) -> None:
        """Run the checks once; their rows (one per check) are kept with the batch."""
        rows = checked.collect()
        self.found.extend(tuple(row) for row in rows)
        if self.strict:
            require(rows)

    def reach(self, name: str, expected: object, make: Callable[[], None]) -> dict[str, DataFrame]:
        """The tables of a layer, stored earlier or by ``make``, which keeps and gates them."""
        terms = {"source": self.source, "strict": self.strict, "expected": expected, "before": self._before}
        first, seen = len(self.staged), len(self.found)
        old = self._stored(name, terms)
        if old:
            self.staged.extend(tables.Staged(**entry) for entry in old["tables"])
            self.found.extend(tuple(row) for row in old["findings"])
            self.taken.append(name)
        else:
            self._fits = False
            make()
        mine = self.staged[first:]
        entries, findings = [asdict(s) for s in mine], [list(row) for row in self.found[seen:]]
        record = {"base": self.base, "terms": terms, "tables": entries, "findings": findings}
        tables.put_manifest(self.spark, self.root, self.batch, self.attempt, name, record)
        content = sorted((s.layer, s.name, s.rows, s.digest) for s in mine)
        self._before = hashlib.sha256(json.dumps(content).encode()).hexdigest()
        # tables of the second layout bear the names of their gold tables; see ``frames``
        return {s.name: tables.staged_frame(self.spark, s) for s in mine if s.layer != colocation.LAYER}

    def _stored(self, name: str, terms: dict) -> dict | None:
        if not self._fits:
            return None
        wanted = json.loads(json.dumps(terms))
        for record in tables.manifests(self.spark, self.root, self.batch, name):
            if record["terms"] == wanted:
                whole = all(tables.is_intact(self.spark, tables.Staged(**e)) for e in record["tables"])
                if whole:
                    return record
        return None


def refresh(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    batch_id: str | None = None,
    expectations: Expectations | None = None,
    strict: bool = True,
    resume: bool = False,
    source: str | None = None,
) -> RefreshResult:
    """Stage bronze, silver and gold, check each, and publish all of it at the end.

    Every layer is read back from its staged files, so a lost executor costs one task and
    not the run. Readers see the new batch only after the last gate. Malformed records,
    unknown labels, keys that are not unique and claims that match no dimension are
    findings, stored with the batch; rejected records are stored as they came.
    ``strict=False`` reports critical findings without stopping. If another refresh publishes
    meanwhile, this one raises ``PublishConflict`` and leaves the other's version current.

    With ``resume`` the batch of an earlier run that failed or was killed goes on after the
    last gate it passed under the same terms; ``source`` tells whether the input is the same.
    """
    batch = batch_id or new_batch_id()
    wanted = expectations or Expectations.none()
    run = Layers(spark, root, batch, source, strict, resume)

    def make_bronze() -> None:
        stored = run.keep("bronze", {name: raw[name] for name in DATASETS})
        rejects = run.keep("checks", {"rejects": silver.rejects(stored)})["rejects"]
        good = {name: silver.well_formed(df) for name, df in stored.items()}
        run.gate(checks.bronze_all(good, wanted.raw).unionByName(checks.rejected(rejects)))
        _require_match(tables.reconcile(spark, run.staged, wanted.raw))

    bronze = run.reach("bronze", wanted.raw, make_bronze)
    bronze = {name: silver.well_formed(bronze[name]) for name in DATASETS}

    def make_silver() -> None:
        cleaned = {**bronze, "beneficiary": strip_quotes(bronze["beneficiary"])}
        stored = run.keep("silver", silver.silver(cleaned))
        run.gate(checks.silver_gate(stored))
        counts = {k: v for k, v in wanted.silver.items() if k in stored}
        _require_match(tables.reconcile(spark, run.staged, counts))

    stg = run.reach("silver", wanted.silver, make_silver)

    def colocate(star: dict[str, DataFrame]) -> Colocated:
        fact, people = run.staged_as("gold", "fact_claims"), run.staged_as("gold", "dim_beneficiary")
        number = colocation.bucket_number(spark, max(fact.rows, people.rows))
        made = colocation.build(
            star["fact_claims"], star["dim_beneficiary"], fact.rows, number,
            lambda made, buckets: run.keep(colocation.LAYER, made, buckets),
        )
        parts = [run.staged_as(colocation.LAYER, name) for name in (colocation.CLAIMS, colocation.HOT_CLAIMS)]
        if sum(int(s.digest) for s in parts) != int(fact.digest):
            raise ValidationError("claims stored by beneficiary differ from fact_claims")
        return colocation.colocated(made)

    def make_gold() -> None:
        dims = run.keep(
            "gold",
            {
                "dim_provider": gold.dim_provider(stg["stg_provider"]),
                "dim_beneficiary": gold.dim_beneficiary(stg["stg_beneficiary"]),
                "dim_date": calendar(spark, stg["stg_claims"], wanted.period),
                "dim_geography": lookups.states(spark),
            },
        )
        fact = gold.fact_claims(
            stg["stg_claims"], dims["dim_provider"], dims["dim_beneficiary"], dims["dim_geography"]
        ).withColumn(MONTH_PARTITION, F.floor(F.col("claim_start_date_key") / 100).cast("int"))
        star = {**dims, **run.keep("gold", {"fact_claims": fact})}
        # stored before the rollups and sets, whose joins with beneficiaries then move no claim
        model = replace(model_from_gold(star), colocated=colocate(star))
        keys = run.keep("keys", {distinct.KEY_ROLLUP: distinct.state_month_keys(in_calendar(model))})
        # the counts of the state rollup come from the stored key sets, the claims are added up only
        counted = distinct.distinct_counts(keys[distinct.KEY_ROLLUP], distinct.GRAIN, distinct.SETS)
        rollups = {name: make(model, stg["stg_claims"]) for name, make in ROLLUPS.items()}
        rollups["agg_state_monthly"] = gold.state_month_rollup(in_calendar(model), counted)
        star.update(run.keep("gold", rollups))
        run.gate(checks.gold_gate(star))
        once = [s for s in run.staged if s.layer != colocation.LAYER]
        _require_match(tables.reconcile(spark, once, wanted.gold))

    star = run.reach("gold", [wanted.gold, wanted.period, colocation.LAYER], make_gold)
    model = replace(
        model_from_gold({name: star[name] for name in [*STAR, *ROLLUPS]}),
        colocated=colocation.colocated(run.frames(colocation.LAYER)),
    )

    def make_lattice() -> None:
        lattice.build(model, lambda made: run.keep("lattice", made))

    run.reach("lattice", None, make_lattice)

    findings = run.keep("checks", {"findings": spark.createDataFrame(run.found, FINDINGS)})["findings"]
    tables.publish(spark, root, run.staged, run.base)
    return RefreshResult(batch, tables.staged_counts(spark, run.staged), findings, tuple(run.taken))


def refresh_from_files(
    spark: SparkSession,
    paths: dict[str, str],
    root: str,
    expectations: Expectations | None = None,
    strict: bool = True,
    resume: str | None = None,
) -> RefreshResult:
    """The same from CSV files: all four must exist before anything is read.

    ``resume`` names the batch of an earlier run that is to go on after its last passed gate;
    source files that have changed since are read anew.
    """
    source_sizes(spark, paths)
    batch = resume or new_batch_id()
    source = _sources_digest(spark, paths)
    return refresh(
        spark, read_all(spark, paths, batch), root, batch, expectations, strict, resume is not None, source
    )


def published_model(spark: SparkSession, root: str) -> ClaimsModel:
    """The model over the current gold tables, key sets, grouping sets and co-located tables,
    ready for every business query."""
    version = tables.latest_version(spark, root)
    stored = {}
    for layer in ("gold", "keys", "lattice"):
        stored.update(tables.read_published(spark, root, layer, version))
    entries = tables.current(spark, root, version).collect()  # one row per table
    rows = {r.table_name: r.table_rows for r in entries if r.layer != colocation.LAYER}
    pair = colocation.colocated(tables.read_published(spark, root, colocation.LAYER, version))
    return replace(model_from_gold(stored), rollup_rows=rows, colocated=pair)
