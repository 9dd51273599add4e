"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "claimward", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC dates.

    Shuffle parallelism is left to the cluster: adaptive execution merges small
    partitions, so the configured number only has to be large enough. The JVM option lets
    the compiler take long generated methods: projections of thirty text columns pass the
    default limit of 8000 bytes and would otherwise run interpreted, many times slower.
    """
    long_methods = "-XX:-DontCompileHugeMethods"
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.extraJavaOptions", long_methods)
        .config("spark.executor.extraJavaOptions", long_methods)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def short_methods(spark: SparkSession) -> None:
    """Generate code operator by operator where that of a whole stage passes 8000 bytes.

    The JVM never compiles a longer method unless it was started as ``build_session`` asks for,
    so in sessions of others projections of thirty text columns would run interpreted.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def hash_joins(spark: SparkSession) -> None:
    """Join by hash, without sorting, where every partition of the smaller side is small.

    Adaptive execution decides on measured partitions; 64 MB is the size it aims at anyway.
    """
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")


def require_shared(folder: str, master: str) -> None:
    """Refuse a folder of the machine's own disk on a cluster."""
    if folder.startswith("file:") and not master.startswith("local"):
        raise ValueError(
            f"set {CHECKPOINT_SETTING}: the warehouse {folder} is a local folder, which "
            f"executors of {master} do not share"
        )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Without the setting it is a folder in the warehouse. On a cluster that must not be on a
    machine's own disk; a folder that the session names is taken as it is.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_claimward_scratch"
        require_shared(folder, spark.sparkContext.master)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/claimward-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage and go on from there.

    Used for aggregates that a query reads more than once (a provider table and the
    benchmark over it), so that the claims behind them are scanned a single time, and
    for row sets whose partition numbers must not change when a task is run again.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
