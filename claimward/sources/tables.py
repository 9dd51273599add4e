"""Table storage: write under a new batch folder, check, then publish.

A refresh never overwrites what readers see. Each table is written to its own batch
folder; after all checks have passed, one commit makes the batch current. A commit is a new
version: one small file that names every current table, put in place whole and only if no
other writer has put that version. Of two refreshes that started from one version, the
first to finish wins and the other fails with its tables unseen. A reader takes one version
for all tables. A failure at any point leaves the previous version in place.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from claimward.session import materialize

VERSION_SCHEMA = (
    "layer string, table_name string, batch_id string, path string, table_rows bigint, "
    "published_at timestamp, columns string, partition_key string, bucket_key string, buckets int"
)


class PublishConflict(Exception):
    """Another writer has published, or taken the batch id, in the meantime."""


@dataclass(frozen=True)
class Staged:
    layer: str
    name: str
    batch_id: str
    path: str
    rows: int
    #: Digest of the content, whatever the order of rows and columns.
    digest: str = ""
    #: Names and types, so that tables without rows can be read too.
    columns: str = ""
    partition_key: str = ""
    #: Key and number of the buckets the rows are stored in; none if 0.
    bucket_key: str = ""
    buckets: int = 0


@dataclass(frozen=True)
class Buckets:
    """How a table is stored in buckets: rows of equal ``key`` share one of ``number``."""

    key: str
    number: int


def columns_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def content_digest(names: list[str]) -> Column:
    """Sum of row hashes as text; it adds up inside the tasks and does not depend on order.

    A missing value counts by its place, since the hash alone passes over it. The hashes are
    added up as three whole numbers of up to 22 bits, since decimals are objects made row by row.
    """
    names = sorted(names)
    row = F.xxhash64(*names, *[F.col(c).isNull() for c in names])
    low = F.lit((1 << 22) - 1).cast("bigint")
    parts = [F.shiftright(row, 44), F.shiftright(row, 22).bitwiseAND(low), row.bitwiseAND(low)]
    high, middle, last = [F.coalesce(F.sum(p), F.lit(0).cast("bigint")).cast("decimal(19,0)") for p in parts]
    weights = [F.lit(1 << bits).cast("decimal(15,0)") for bits in (44, 22)]
    return (high * weights[0] + middle * weights[1] + last).cast("decimal(38,0)").cast("string")


def stage(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    batch_id: str,
    partition_by: str | None = None,
    attempt: int = 0,
    buckets: Buckets | None = None,
) -> Staged:
    """Write one table and verify that every row arrived.

    Rows are counted and their content digested while they are written; the stored files
    are counted again. A batch that is taken up again writes to folders of its own. Buckets
    have one file each, in every partition where there are partitions as well.
    """
    path = f"{root.rstrip('/')}/{layer}/{name}/batch={batch_id}"
    if attempt:
        path += f"-again{attempt}"
    seen = Observation(f"{layer}_{name}")
    # adaptive execution splits a month that holds most rows and merges small ones; rows are
    # counted behind that shuffle, in the writing tasks, so a task run again counts once
    if buckets:
        spread = df.repartition(buckets.number, buckets.key)
    else:
        spread = df.hint("rebalance", partition_by) if partition_by else df
    counted = spread.observe(
        seen, F.count(F.lit(1)).alias("rows"), content_digest(df.columns).alias("digest")
    )
    places = {"columns": columns_of(df), "partition_key": partition_by or ""}
    if buckets:
        places |= {"bucket_key": buckets.key, "buckets": buckets.number}
        table = declare_buckets(df.sparkSession, path, **places)
        order = [c for c in df.columns if c != partition_by] + [partition_by] * bool(partition_by)
        counted.select(*order).write.insertInto(table, overwrite=True)
    else:
        writer = counted.write.partitionBy(partition_by) if partition_by else counted.write
        writer.mode("overwrite").parquet(path)
    written = seen.get["rows"]
    stored = df.sparkSession.read.schema(df.schema).parquet(path).count()
    if stored != written:
        raise RuntimeError(f"{layer}.{name}: wrote {written} rows, found {stored}")
    return Staged(layer, name, batch_id, path, stored, seen.get["digest"], **places)


def declare_buckets(
    spark: SparkSession, path: str, columns: str, partition_key: str, bucket_key: str, buckets: int
) -> str:
    """Name of a table in the session's catalog over files that are stored in buckets.

    Files alone do not tell how they are bucketed, so every session declares the table before
    it writes or reads it. The name follows from the path and the layout.
    """
    told = json.dumps([path, columns, partition_key, bucket_key, buckets])
    name = f"claimward_{hashlib.sha256(told.encode()).hexdigest()[:24]}"
    if not spark.catalog.tableExists(name):
        by = f"PARTITIONED BY (`{partition_key}`)" if partition_key else ""
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {by} "
            f"CLUSTERED BY (`{bucket_key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        store, folder = _store(spark, path)
        if by and store.exists(folder):
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def files_of(spark: SparkSession, path: str, columns: str | None) -> DataFrame:
    """The rows below a path; without given columns their types come from the files."""
    reader = spark.read.option("basePath", path)
    return (reader.schema(columns) if columns else reader).parquet(path)


def stored_frame(spark: SparkSession, table: Staged | Row) -> DataFrame:
    """A table as staged or published; buckets are known to the optimizer."""
    if not table.buckets:
        return files_of(spark, table.path, table.columns)
    layout = (table.columns, table.partition_key, table.bucket_key, table.buckets)
    return spark.table(declare_buckets(spark, table.path, *layout))


def staged_frame(spark: SparkSession, staged: Staged) -> DataFrame:
    return stored_frame(spark, staged)


def is_intact(spark: SparkSession, staged: Staged) -> bool:
    """Whether the stored files still hold the rows that were written."""
    store, place = _store(spark, staged.path)
    if not store.exists(place):
        return False
    df = files_of(spark, staged.path, staged.columns)
    row = df.agg(F.count(F.lit(1)).alias("rows"), content_digest(df.columns).alias("digest")).first()
    return (row.rows, row.digest) == (staged.rows, staged.digest)


def staged_counts(spark: SparkSession, staged: list[Staged]) -> DataFrame:
    rows = [(s.layer, s.name, s.rows) for s in staged]
    return spark.createDataFrame(rows, "layer string, table_name string, rows_written bigint")


def reconcile(spark: SparkSession, staged: list[Staged], expected: dict[str, int]) -> DataFrame:
    """Rows written against rows expected; tables without an expectation count as matched."""
    wanted = spark.createDataFrame(
        [(name, count) for name, count in expected.items()],
        "table_name string, expected_rows bigint",
    )
    return (
        staged_counts(spark, staged)
        .join(wanted, "table_name", "left")
        .withColumn(
            "matched",
            F.col("expected_rows").isNull() | (F.col("rows_written") == F.col("expected_rows")),
        )
    )


def _ledger_path(root: str) -> str:
    return f"{root.rstrip('/')}/_published"


def _store(spark: SparkSession, path: str):
    """The file system of a path and the path in it, as the cluster resolves them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def put_if_absent(spark: SparkSession, path: str, content: str) -> bool:
    """Put a small file in place whole; False if there is one already.

    It is written under a name of its own and then linked (plain files) or renamed, which
    fails where the target exists. That is one step on HDFS and on POSIX files; a store whose
    rename copies needs a lock service beside it.
    """
    store, place = _store(spark, path)
    spare = f"{path}.{uuid.uuid4().hex}"
    store.mkdirs(place.getParent())
    if store.getScheme() == "file":
        target = place.toUri().getPath()
        own = f"{target}.{uuid.uuid4().hex}"
        with open(own, "w", encoding="utf-8") as out:
            out.write(content)
        try:
            os.link(own, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
        return True
    spare_place = spark._jvm.org.apache.hadoop.fs.Path(spare)
    out = store.create(spare_place, False)
    out.write(bytearray(content, "utf-8"))
    out.close()
    done = not store.exists(place) and store.rename(spare_place, place)
    if not done:
        store.delete(spare_place, False)
    return bool(done)


def _batch_path(root: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/_batches/{batch_id}"


def claim_batch(spark: SparkSession, root: str, batch_id: str, attempt: int = 0) -> None:
    """Take a batch id, or an attempt at it, for one refresh; ids have the grain of a second."""
    suffix = f"-again{attempt}" if attempt else ""
    if not put_if_absent(spark, _batch_path(root, batch_id) + suffix, uuid.uuid4().hex):
        raise PublishConflict(f"batch {batch_id}{suffix} belongs to another refresh")


def next_attempt(spark: SparkSession, root: str, batch_id: str) -> int:
    """Number of the next attempt at a batch; 0 if nobody has begun it."""
    attempt = 0
    while True:
        store, place = _store(spark, _batch_path(root, batch_id) + (f"-again{attempt}" if attempt else ""))
        if not store.exists(place):
            return attempt
        attempt += 1


def put_manifest(
    spark: SparkSession, root: str, batch_id: str, attempt: int, layer: str, content: dict
) -> None:
    """Record that a layer of an attempt has passed its gate."""
    path = f"{_batch_path(root, batch_id)}.passed/{layer}-{attempt}.json"
    if not put_if_absent(spark, path, json.dumps(content)):
        raise PublishConflict(f"{path} was written by another refresh")


def manifests(spark: SparkSession, root: str, batch_id: str, layer: str) -> list[dict]:
    """Records of a layer of a batch, those of the newest attempt first."""
    store, place = _store(spark, f"{_batch_path(root, batch_id)}.passed")
    if not store.exists(place):
        return []
    found = {}
    for name in [f.getPath().getName() for f in store.listStatus(place)]:
        kind, _, number = name.removesuffix(".json").rpartition("-")
        if kind == layer and name.endswith(".json"):
            found[int(number)] = f"{_batch_path(root, batch_id)}.passed/{name}"
    texts = [spark.read.text(found[n], wholetext=True).first() for n in sorted(found, reverse=True)]
    return [json.loads(row.value) for row in texts]


def _version_path(root: str, version: int) -> str:
    return f"{_ledger_path(root)}/v{version:010d}.json"


def latest_version(spark: SparkSession, root: str) -> int:
    """Number of the newest version; 0 before the first."""
    store, place = _store(spark, _ledger_path(root))
    if not store.exists(place):
        return 0
    names = [f.getPath().getName() for f in store.listStatus(place)]
    return max((int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")), default=0)


def publish(spark: SparkSession, root: str, staged: list[Staged], base: int | None = None) -> int:
    """Make the staged tables current, as the version after ``base`` (by default the newest).

    Tables that are not staged keep their entry. Returns the new version's number.
    """
    base = latest_version(spark, root) if base is None else base
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    entries = {}
    if base:
        for row in current(spark, root, base).collect():  # one row per table
            at = row.published_at.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
            entries[row.layer, row.table_name] = row.asDict() | {"published_at": at}
    for s in staged:
        entry = asdict(s)
        entry["table_name"], entry["table_rows"] = entry.pop("name"), entry.pop("rows")
        del entry["digest"]
        entries[s.layer, s.name] = entry | {"published_at": now}
    lines = "".join(json.dumps(e) + "\n" for e in entries.values())
    if not put_if_absent(spark, _version_path(root, base + 1), lines):
        raise PublishConflict(f"version {base + 1} of {root} was published by another refresh")
    return base + 1


def current(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Every table of a version, by default of the newest."""
    version = latest_version(spark, root) if version is None else version
    if not version:
        raise FileNotFoundError(f"nothing is published under {root}")
    return spark.read.schema(VERSION_SCHEMA).json(_version_path(root, version))


def read_published(
    spark: SparkSession, root: str, layer: str, version: int | None = None
) -> dict[str, DataFrame]:
    """All tables of a layer as one version has them."""
    entries = current(spark, root, version).filter(F.col("layer") == layer).collect()
    return {row.table_name: stored_frame(spark, row) for row in entries}


def write_report(report: DataFrame, path: str) -> DataFrame:
    """A profile report as JSON lines, returned as stored."""
    report.write.mode("overwrite").json(path)
    return report.sparkSession.read.schema(report.schema).json(path)


__all__ = [
    "Buckets",
    "PublishConflict",
    "Staged",
    "claim_batch",
    "content_digest",
    "current",
    "declare_buckets",
    "is_intact",
    "latest_version",
    "manifests",
    "materialize",
    "next_attempt",
    "publish",
    "put_manifest",
    "read_published",
    "reconcile",
    "stage",
    "staged_counts",
    "staged_frame",
    "stored_frame",
    "write_report",
]
