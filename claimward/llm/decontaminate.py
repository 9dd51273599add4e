"""Benchmark decontamination by spaced-seed hashing, in Spark SQL functions only.

Texts are cut into lower-case tokens of letters and digits; in scripts written without
spaces every letter is a token. Fixed masks pick some token
positions of a window and ignore the others, so that a substituted token leaves seeds
intact. Seeds of documents meet seeds of benchmark items in an equi-join; every hit names
an alignment of an item with a document. The aligned tokens are then compared one by one,
and a document is contaminated if an alignment agrees in at least ``share`` of the item's
tokens, or in ``run_share`` of any ``run`` tokens in a row.

The seeds are complete: ``TRIPLES`` are all ways to pick three of at most five tokens in a
row, and every alignment that passes the thresholds has such triples. ``least_triples`` counts how
many it has at least; alignments with fewer are not compared. Items under ``SHORTEST``
tokens must agree in all tokens, in a row anywhere in a text; those under ``PHRASE`` tokens are
ordinary phrases inside a text and must be the whole text. Null and empty texts, and items
without a token, match nothing. Items with equal tokens count once. A document is known by its id and
a hash of its text, so null and repeated ids are judged row by row. Extra columns are left
out. The seeds of the benchmark are broadcast only if their counted number is at most
``BROADCAST_SEEDS``; otherwise the join shuffles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimward.llm.common import stored, table

TRIPLES = ("111", "1101", "1011", "11001", "10101", "10011")
WHOLE = -1  # stands for a mask in the seed of a whole short text
#: The longer masks of the SQL twin, which loses alignments with many substitutions.
MASKS = ("110100110111", "111011001011", "101101110011")
SPAN = len(MASKS[0])
#: Fewest tokens for which a share is enough.
SHORTEST = 8
#: Fewest tokens that count inside a longer text.
PHRASE = 5
SHARE = 0.6
RUN = 20
RUN_SHARE = 0.8
BROADCAST_SEEDS = 500_000


#: Thai to Tibetan, Myanmar, Khmer, Tai, Balinese, Javanese, kana and Han
UNSPACED = (
    r"\u0E00-\u109F\u1780-\u17FF\u1950-\u19FF\u1A20-\u1AAF\u1B00-\u1B7F\u3005-\u3007\u3021-\u3029\u3031-\u312F"
    r"\u31A0-\u31BF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uA980-\uA9FF\uAA60-\uAADF\uF900-\uFAFF\uFF66-\uFF9F"
    r"\x{1AFF0}-\x{1B16F}\x{20000}-\x{3FFFF}"
)
TOKEN = rf"[\p{{L}}\p{{N}}&&[^{UNSPACED}]]+|[\p{{L}}\p{{N}}]"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def least_triples(size: int, matched: int) -> int:
    """Fewest triples of ``TRIPLES`` among ``matched`` of ``size`` places, however they lie."""
    fewest = {(0, 0): 0}  # by (which of the last four places match, matches so far)
    for _ in range(size):
        after: dict[tuple[int, int], int] = {}
        for (last, so_far), triples in fewest.items():
            near = last.bit_count()
            for bit, more in ((0, 0), (1, near * (near - 1) // 2)):
                key = (last << 1 & 15 | bit, so_far + bit)
                after[key] = min(after.get(key, triples + more), triples + more)
        fewest = after
    return min(n for (_, so_far), n in fewest.items() if so_far == matched)


def _least_by_size() -> list[int]:
    """Triples that a contaminating alignment has at least, by item size; the last entry is for
    longer items: cut into parts of 30 to 60 tokens, one part agrees as much as the whole."""
    run = least_triples(RUN, math.ceil(RUN_SHARE * RUN))
    least = [1] * PHRASE + [least_triples(size, size) for size in range(PHRASE, SHORTEST)]
    for size in range(SHORTEST, 61):
        of_share = least_triples(size, math.ceil(round(SHARE * size, 6)))
        least.append(min(of_share, run) if size >= RUN else of_share)
    return [*least, min(least[30:])]


def seeds(hashed: Column) -> Column:
    """Array, by position, of arrays of one seed per mask. Masks that reach past the end hash
    fewer tokens and meet no seed of an item. A text under ``PHRASE`` tokens has one more
    seed, of all its tokens."""

    def at(i: Column) -> Column:
        return F.array(
            *[
                F.xxhash64(F.lit(n), *[F.get(hashed, i + k) for k, bit in enumerate(mask) if bit == "1"])
                for n, mask in enumerate(TRIPLES)
            ]
        )

    places = F.transform(F.sequence(F.lit(0), F.size(hashed) - 1), at)
    whole = F.array(F.array(F.xxhash64(F.lit(WHOLE), hashed)))
    return (
        F.when(F.size(hashed) >= PHRASE, places)
        .when(F.size(hashed) > 0, F.concat(places, whole))
        .otherwise(F.array().cast("array<array<bigint>>"))
    )


def seeded(rows: DataFrame, keep: list[str]) -> DataFrame:
    """One row per (row, position, seed); ``rows`` has an array of hashed tokens."""
    by_place = rows.select(*keep, F.posexplode(seeds(F.col("hashed"))).alias("place", "at_place"))
    return by_place.select(*keep, "place", F.posexplode("at_place").alias("mask", "seed"))


def _hashed(column: str) -> Column:
    return F.transform(column, lambda t: F.xxhash64(t))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item_id and item_tokens of all items that have a token, equal ones once."""
    cut = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), tokens(F.col("text")).alias("item_tokens"))
    return (
        cut.filter(F.size("item_tokens") > 0)
        .groupBy("item_tokens")
        .agg(F.min("item_id").alias("item_id"))
    )


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )


def alignments(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (doc_id, text_key, item_id, shift) that enough seeds suggest; shift is where in
    the document the item would begin."""
    sized = items.select("item_id", _hashed("item_tokens").alias("hashed"), F.size("item_tokens").alias("item_size"))
    spans = F.array(*[F.lit(len(mask)) for mask in TRIPLES])
    of_items = stored(
        seeded(sized, ["item_id", "item_size"])
        .filter(
            F.when(F.col("item_size") < PHRASE, F.col("place") == F.col("item_size")).otherwise(
                F.col("place") + F.get(spans, F.col("mask")) <= F.col("item_size")
            )
        )
        .select("item_id", F.col("place").alias("item_place"), "seed", "item_size"),
        "item-seeds",
    )
    if of_items.count() <= BROADCAST_SEEDS:
        of_items = F.broadcast(of_items)
    hashed = documents.select("doc_id", "text_key", _hashed("tokens").alias("hashed"))
    by_size = _least_by_size()
    least = F.get(F.array(*[F.lit(n) for n in by_size]), F.least(F.col("item_size"), F.lit(len(by_size) - 1)))
    return (
        seeded(hashed, ["doc_id", "text_key"])
        .join(of_items, "seed")
        .groupBy("doc_id", "text_key", "item_id", "item_size", (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(F.count(F.lit(1)).alias("triples"))
        .filter(F.col("triples") >= least)
        .drop("triples")
    )


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item: best alignment and what agrees."""
    items = stored(benchmark_items(benchmark), "items")
    keyed = _keyed(documents)
    found = stored(
        alignments(keyed.select("doc_id", "text_key", tokens(F.col("text")).alias("tokens")), items), "alignments"
    )
    skipped = F.greatest(-F.col("shift"), F.lit(0))  # item tokens before the document begins
    around = (
        keyed.join(
            found.withColumnsRenamed({"doc_id": "of_doc", "text_key": "of_text"}),
            F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text")),
        )
        .select("doc_id", "text_key", "item_id", "item_size", "shift", tokens(F.col("text")).alias("tokens"))
        .select(
            "doc_id", "text_key", "item_id", "item_size", "shift",
            F.slice("tokens", F.greatest(F.col("shift"), F.lit(0)) + 1, F.col("item_size") - skipped).alias("here"),
        )
    )
    agree = F.zip_with(
        "here",
        F.slice("item_tokens", skipped + 1, F.greatest(F.size("here"), F.lit(0))),
        lambda x, y: (x == y).cast("int"),
    )
    runs = F.when(
        F.size("agree") >= RUN,
        F.array_max(
            F.transform(
                F.sequence(F.lit(1), F.size("agree") - RUN + 1),
                lambda i: F.aggregate(F.slice("agree", i, RUN), F.lit(0), lambda a, x: a + x),
            )
        ),
    ).otherwise(0)
    checked = around.join(items, "item_id").withColumn("agree", agree).select(
        "doc_id", "text_key", "item_id", "item_size", "shift",
        F.aggregate("agree", F.lit(0), lambda a, x: a + x).alias("matched"),
        runs.alias("best_run"),
    )
    share = F.when(F.col("item_size") < SHORTEST, 1.0).otherwise(SHARE)
    return (
        checked.filter((F.col("matched") >= share * F.col("item_size")) | (F.col("best_run") >= RUN_SHARE * RUN))
        .groupBy("doc_id", "text_key", "item_id")
        .agg(F.max(F.struct("matched", (-F.col("shift")).alias("back"), "item_size")).alias("best"))
        .select(
            "doc_id", "text_key", "item_id",
            F.col("best.matched").alias("matched"),
            (-F.col("best.back")).alias("first_token"),
            F.col("best.item_size").alias("item_size"),
        )
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that hold a benchmark item."""
    bad = stored(
        contaminated(documents, benchmark)
        .select(F.col("doc_id").alias("bad_doc"), F.col("text_key").alias("bad_text"))
        .distinct(),
        "contaminated",
    )
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("bad_doc")) & (F.xxhash64("text") == F.col("bad_text"))
    return documents.join(bad, same, "left_anti")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document."""
    hits = contaminated(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return (
        hits.groupBy("doc_id", "text_key")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.max("matched").cast("bigint").alias("matched_tokens"),
            F.max(F.round(F.col("matched") / F.col("item_size"), 6)).alias("matched_share"),
        )
        .drop("text_key")
    )


def _sql_seed(mask: str, list_name: str) -> str:
    picked = [f"{list_name}[i + {k + 1}]" for k, bit in enumerate(mask) if bit == "1"]
    return f"'{mask} ' || " + " || ' ' || ".join(picked)


def _sql_seeds(table_name: str, key: str) -> str:
    rows = f"SELECT {key}, t, unnest(range(0, len(t) - {SPAN - 1})) AS i FROM {table_name} WHERE len(t) >= {SPAN}"
    return " UNION ALL ".join(f"SELECT {key}, i, {_sql_seed(m, 't')} AS seed FROM ({rows})" for m in MASKS)


_SQL_TOKENS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_TOKENS} AS t FROM documents),
b AS (
  SELECT t, min(item_id) AS item_id FROM (SELECT item_id, {_SQL_TOKENS} AS t FROM benchmark)
  WHERE len(t) >= {SHORTEST} GROUP BY t
),
ds AS ({_sql_seeds("d", "doc_id")}), bs AS ({_sql_seeds("b", "item_id")}),
found AS (SELECT DISTINCT doc_id, item_id, ds.i - bs.i AS shift FROM ds JOIN bs USING (seed)),
checked AS (
  SELECT f.doc_id, f.item_id, len(b.t) AS item_size,
    list_transform(range(1, len(b.t) + 1), lambda j: CASE WHEN f.shift + j >= 1 AND d.t[f.shift + j] = b.t[j] THEN 1 ELSE 0 END) AS agree
  FROM found f JOIN d USING (doc_id) JOIN b USING (item_id)
),
scored AS (
  SELECT doc_id, item_id, item_size, list_sum(agree) AS matched,
    CASE WHEN item_size >= {RUN}
      THEN list_max(list_transform(range(1, item_size - {RUN - 2}), lambda s: list_sum(agree[s:s + {RUN - 1}]))) ELSE 0 END AS best_run
  FROM checked
),
best AS (
  SELECT doc_id, item_id, max(matched) AS matched, any_value(item_size) AS item_size FROM scored
  WHERE matched >= {SHARE} * item_size OR best_run >= {RUN_SHARE * RUN} GROUP BY 1, 2
)
SELECT doc_id, count(*) AS n_items, CAST(max(matched) AS BIGINT) AS matched_tokens,
  max(round(matched / item_size, 6)) AS matched_share
FROM best GROUP BY doc_id
"""
