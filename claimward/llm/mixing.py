"""Mixing sources to target weights by capped water-filling.

Every source wants a share of the budget in proportion to its weight, but never more than
``epochs`` times its own words. Sources over that cap are clamped and what they leave is
shared among the others by weight, until none is above its cap. A source that wants ``e``
epochs then repeats all its documents ``floor(e)`` times, and for the rest takes documents
in seeded random order until the words are used up.

The random order is cut into slices of a bounded number of documents (``SLICE_DOCS``), so
that a source with a third of all rows is many small windows. Within a slice the documents
up to the last that fits are taken, and of the others the one whose size comes nearest to
what is left. Rows with equal ids and equal texts share their draw.

Null texts and texts without words have size 0 and are taken 0 words; a null source is a
source of its own, last in order. An empty table gives an empty result. Words are counted
in 64 bits, and budgets and rates come from whole sums, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from claimward.functions.ranks import key_positions
from claimward.llm.common import stored, table, word_count

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
EPOCHS = 2
SEED = 17
SLICE_DOCS = 10_000


def source_sizes(sized: DataFrame) -> DataFrame:
    """Rows and words per source, with weights dealt in code point order, null last."""
    totals = stored(
        sized.groupBy("source").agg(
            F.count(F.lit(1)).alias("source_rows"), F.sum("size").alias("source_size")
        ),
        "mix-sources",
    ).withColumn("missing", F.col("source").isNull())
    places = key_positions(totals, [("missing", "asc"), ("source", "asc")]).select(
        F.col("source").alias("placed"), "keys_before"
    )
    weight = F.element_at(
        F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("keys_before") % len(WEIGHTS) + 1).cast("int")
    )
    return totals.join(places, F.col("source").eqNullSafe(F.col("placed"))).select(
        "source", "source_rows", "source_size", weight.cast("bigint").alias("weight")
    )


def water_level(sources: DataFrame, budget: float, epochs: float) -> float | None:
    """Words per unit of weight once every source over its cap is clamped; None: all are.

    Only sums over all sources reach the driver. Clamping never lowers the level, so a
    clamped source stays clamped and the loop ends when no further one joins.
    """
    over = F.col("weight") * F.col("level") > F.col("source_size") * epochs

    def sums(level: float):
        return (
            sources.withColumn("level", F.lit(level))
            .agg(
                F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"),
                F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)).alias("clamped"),
                F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open_weight"),
            )
            .first()
        )

    level, clamped = 0.0, None
    while True:
        now = sums(level)
        if not now.open_weight:
            return None
        if clamped is not None and now.clamped == clamped[0] and now.open_weight == clamped[1]:
            return level
        clamped = (now.clamped, now.open_weight)
        level = (budget * now.words - epochs * now.clamped) / now.open_weight


def targets(sized: DataFrame, budget: float = BUDGET, epochs: float = EPOCHS) -> DataFrame:
    """One row per source: rows, size, weight, target words, epochs wanted."""
    sources = stored(source_sizes(sized), "mix-weights")
    level = water_level(sources, budget, epochs)
    cap = F.col("source_size") * float(epochs)
    target = cap if level is None else F.least(cap, F.col("weight") * F.lit(level))
    return sources.withColumn("target", target.cast("double")).withColumn(
        "epochs", F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    )


def order_key(id_column: str, seed: int) -> Column:
    """Place in the random order. The text counts as well, so rows without an id, or with a
    repeated one, are drawn one by one unless their texts are equal too."""
    return F.xxhash64(F.lit(seed), F.col(id_column), F.col("text"))


def placed(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Add the source's numbers and the slice of the row's key."""
    numbers = per_source.select(
        F.col("source").alias("of_source"),
        "source_size",
        "target",
        F.floor("epochs").cast("bigint").alias("whole_epochs"),
        (F.col("epochs") - F.floor("epochs")).alias("part_epoch"),
        F.ceil(F.col("source_rows") / SLICE_DOCS).cast("bigint").alias("slices"),
    )
    slice_no = F.pmod(F.xxhash64(F.col("draw_key"), F.lit("slice")), F.col("slices"))
    return (
        rows.join(numbers, F.col("source").eqNullSafe(F.col("of_source")))
        .drop("of_source")
        .withColumn("slice", slice_no)
    )


def draws(sized: DataFrame, per_source: DataFrame) -> DataFrame:
    """What each slice takes once more, one row per (source, slice).

    ``sized``: source, size, draw_key. A document is drawn if its key is at most
    ``last_key`` or equals ``extra_key``.
    """
    slice_of = Window.partitionBy("source", "slice")
    up_to = slice_of.orderBy("draw_key").rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("wanted") - F.max(F.when(F.col("fits"), F.col("so_far")).otherwise(0)).over(slice_of)
    miss = F.abs(F.col("size") - F.col("left"))
    return (
        placed(sized, per_source)
        .groupBy("source", "slice", "part_epoch", "draw_key")
        .agg(F.sum("size").alias("size"))
        .withColumn("so_far", F.sum("size").over(up_to))
        .withColumn("wanted", F.sum("size").over(slice_of) * F.col("part_epoch"))
        .withColumn("fits", (F.col("so_far") <= F.col("wanted")) & (F.col("part_epoch") > 0))
        .withColumn("left", left)
        .groupBy("source", "slice")
        .agg(
            F.max(F.when(F.col("fits"), F.col("draw_key"))).alias("last_key"),
            F.min(F.when(~F.col("fits") & (miss < F.col("left")), F.struct(miss.alias("miss"), "draw_key")))[
                "draw_key"
            ].alias("extra_key"),
        )
    )


def repetitions(rows: DataFrame, per_source: DataFrame, drawn: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and ``times``, how often the mix has the row.

    Rows meet their draw through source, slice and key, not through their id, so no text
    is joined by document.
    """
    slices = drawn.withColumnsRenamed({"source": "of_source", "slice": "of_slice"})
    here = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("slice") == F.col("of_slice"))
    by_key = F.col("draw_key") <= F.col("last_key")
    extra = F.col("draw_key") == F.col("extra_key")
    once_more = F.coalesce(by_key, F.lit(False)) | F.coalesce(extra, F.lit(False))
    return (
        placed(rows, per_source)
        .join(slices, here, "left")
        .withColumn("times", F.col("whole_epochs") + once_more.cast("bigint"))
    )


def _planned(documents: DataFrame, budget: float, epochs: float, seed: int, id_column: str):
    sized = stored(
        documents.select(
            id_column,
            "source",
            word_count(F.col("text")).alias("size"),
            order_key(id_column, seed).alias("draw_key"),
        ),
        "mix-sizes",
    )
    per_source = stored(targets(sized, budget, epochs), "mix-targets")
    drawn = stored(draws(sized.select("source", "size", "draw_key"), per_source), "mix-draws")
    return sized, per_source, drawn


def mix(
    documents: DataFrame,
    budget: float = BUDGET,
    epochs: float = EPOCHS,
    seed: int = SEED,
    id_column: str = "doc_id",
) -> DataFrame:
    """The mixed corpus: every row of ``documents`` as often as the mix has it."""
    _, per_source, drawn = _planned(documents, budget, epochs, seed, id_column)
    rows = documents.select(
        F.struct(*documents.columns).alias("row"),
        F.col("source"),
        order_key(id_column, seed).alias("draw_key"),
    )
    return (
        repetitions(rows, per_source, drawn)
        .filter("times > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))))
        .select("row.*")
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return repetitions(*_planned(documents, BUDGET, EPOCHS, SEED, "doc_id")).select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken")
    )
