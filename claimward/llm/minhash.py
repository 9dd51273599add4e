"""Near-duplicates by circulant MinHash with exact confirmation.

A document's set of word shingles is hashed into 2^16 slots. One random permutation places
the slots on a circle, and the same second permutation, shifted by one place for every
coordinate, gives each minimum of the signature. Coordinates are banded; documents that
share a band meet.

1. Documents with equal sets form a class; its smallest id stands for it from here on.
2. Every member is compared, on full sets, with one document: the smallest of all its
   buckets' smallest members. Links give connected components.
3. Members that are still in another component than some bucket's smallest are compared
   with that one too.
4. What is left in a bucket are members outside the component of its smallest. They are
   compared with all other members that are in another component than their own, in blocks
   of bounded size: a task gets two blocks, counts common shingles by a matrix product and
   returns links only. Members inside that component are not compared with each other.

Bands are as many as needed to miss a pair at the threshold with a probability of at most
``MISS``. No bucket or number of partners is capped. Bucket contents are joined, never
gathered; a bucket with a third of all rows is combined before it is shuffled. A pair that
shares no band, or whose documents are already connected, is never looked at.

Documents without words have an empty set and no link. A document without an id takes part
in no group and is kept. Rows with one id are one document. Extra columns are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimward.llm.common import stored, table
from claimward.llm.components import components
from claimward.llm.texts import chunks, mixed, windows, word_hashes

SLOTS = 1 << 16
ROWS = 7
MISS = 1e-5
SEED = 20_011
#: Members of a bucket that a task compares with as many others at once.
BLOCK = 512
COLUMNS = 4096


@dataclass(frozen=True)
class Likeness:
    """Shingle width and the similarity, in hundredths, from which documents are linked."""

    width: int
    percent: int

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MISS) / math.log(1 - (self.percent / 100) ** ROWS))

    @property
    def smallest_unequal(self) -> int:
        """Words sets smaller than this can only be linked to equal sets."""
        n = 1
        while 100 * n < self.percent * (n + 1):
            n += 1
        return n

    def linked(self, common: Column, union: Column) -> Column:
        return 100 * common >= self.percent * union

    def sizes_fit(self, one: Column, other: Column) -> Column:
        return 100 * F.least(one, other) >= self.percent * F.greatest(one, other)


CONTRACT = Likeness(width=3, percent=85)
STANDARD = Likeness(width=5, percent=80)


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's set begins.

    A text with fewer words than ``width`` has its whole word sequence as one shingle.
    """
    hashes, starts = word_hashes([t.lower().split() for t in texts])
    keys, owner, _ = windows(hashes, starts, width)
    counts = np.diff(starts)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = counts[short] > k
            whole[has] = mixed(whole[has] + hashes[starts[short][has] + k] + np.uint64(k + 1))
        keys, owner = np.concatenate([keys, whole]), np.concatenate([owner, short])
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[new], owner[new]
    return keys, np.searchsorted(owner, np.arange(len(texts) + 1))


def permutations(count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Places of the slots on the circle, and the values on it, repeated for the shifts."""
    rng = np.random.default_rng(seed)
    places = rng.permutation(SLOTS)
    values = rng.permutation(SLOTS).astype(np.uint16)
    return places, np.concatenate([values, values[:count]])


def signatures(keys: np.ndarray, edges: np.ndarray, count: int, perms) -> np.ndarray:
    """``count`` coordinates for every set; sets must not be empty."""
    places, values = perms
    spots = places[(mixed(keys) >> np.uint64(48)).astype(np.int64)]
    out = np.empty((count, len(edges) - 1), np.uint16)
    found = np.empty(len(spots), np.uint16)
    for shift in range(count):
        values[shift : shift + SLOTS].take(spots, out=found, mode="clip")
        out[shift] = np.minimum.reduceat(found, edges[:-1])
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band and set, shape (sets, bands)."""
    keys = np.empty((signature.shape[1], bands), np.uint64)
    for band in range(bands):
        key = np.full(signature.shape[1], band + 1, np.uint64)
        for row in range(ROWS):
            key = mixed(key + signature[band * ROWS + row].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        keys[:, band] = key
    return keys


def _sketch(documents: DataFrame, like: Likeness) -> DataFrame:
    """Per document: size and digests of its set, and its bands if it can have unequal links."""
    bands, least, width = like.bands, like.smallest_unequal, like.width

    def run(batches):
        perms = permutations(bands * ROWS)
        for batch in batches:
            for ids, texts in chunks(batch.column("doc_id"), batch.column("text")):
                keys, edges = shingle_sets(texts, width)
                sizes = np.diff(edges)
                sums = [np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)]
                full = np.flatnonzero(sizes)
                if len(full):
                    for k, total in enumerate(sums):
                        values = mixed(keys ^ np.uint64(0xA5A5A5A5 + k))
                        total[full] = np.add.reduceat(values, edges[:-1][full])
                wide = np.flatnonzero(sizes >= least)
                lists: list = [None] * len(texts)
                if len(wide):
                    take = np.repeat(sizes >= least, sizes)
                    inner = np.concatenate([[0], np.cumsum(sizes[wide])])
                    for i, row in zip(wide, band_keys(signatures(keys[take], inner, bands * ROWS, perms), bands)):
                        lists[i] = row.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "digest_a", "digest_b", "bands"],
                )

    return documents.mapInArrow(
        run, "doc_id bigint, n bigint, digest_a bigint, digest_b bigint, bands array<bigint>"
    )


def _sets(documents: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for ids, texts in chunks(batch.column("doc_id"), batch.column("text")):
                keys, edges = shingle_sets(texts, width)
                lists = pa.ListArray.from_arrays(
                    pa.array(edges, pa.int32()), pa.array(keys.view(np.int64), pa.int64())
                )
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], names=["node", "shingles"])

    return documents.mapInArrow(run, "node bigint, shingles array<bigint>")


def _compared(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """Pairs (a, b) with the size of the common and of the united set."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b")).cast("bigint")
    return (
        pairs.join(one, "a")
        .join(other, "b")
        .select("a", "b", common.alias("common"), (F.size("of_a") + F.size("of_b")).alias("both"))
        .select("a", "b", "common", (F.col("both") - F.col("common")).alias("union"))
    )


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) whose documents are in different components; alone is a component too."""
    of_a = found.select(F.col("node").alias("a"), F.col("component").alias("in_a"))
    of_b = found.select(F.col("node").alias("b"), F.col("component").alias("in_b"))
    both = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return both.filter(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).select("a", "b")


def _in_blocks(members: DataFrame) -> DataFrame:
    """(bucket, one, two, node, component) for every pair of blocks to be compared.

    Members outside the component of their bucket's smallest fill the first blocks, the
    others the blocks behind them; pairs of the latter are left out.
    """
    outside = F.col("component") != F.col("pivot_component")
    counts = (
        members.groupBy("bucket")
        .agg(F.count_if(outside).alias("n_outside"), F.count(F.lit(1)).alias("n_members"))
        # the only pair of a bucket of two has been compared before
        .filter("n_outside > 0 and n_members > 2")
        .select(
            "bucket",
            F.ceil(F.col("n_outside") / BLOCK).alias("outer"),
            F.ceil((F.col("n_members") - F.col("n_outside")) / BLOCK).alias("inner"),
        )
    )
    spread = F.xxhash64("node")
    own = F.when(outside, F.pmod(spread, F.col("outer"))).otherwise(
        F.col("outer") + F.pmod(spread, F.greatest("inner", F.lit(1)))
    )
    last = F.when(outside, F.col("outer") + F.col("inner") - 1).otherwise(F.col("outer") - 1)
    return (
        members.join(counts, "bucket")
        .select("bucket", "node", "component", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("other"))
        .select("bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "node", "component")
    )


def block_links(nodes: np.ndarray, groups: np.ndarray, keys: np.ndarray, edges: np.ndarray, percent: int):
    """Linked pairs (smaller, larger node) of different groups, by exact counts.

    Shingles that one set has alone cannot be common; the others are columns of a 0/1
    matrix, taken some thousand at a time.
    """
    sizes = np.diff(edges)
    _, column, often = np.unique(keys, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(nodes)), sizes)
    useful = often[column] > 1
    row, column = row[useful], (np.cumsum(often > 1) - 1)[column[useful]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(nodes), len(nodes)), np.float32)
    low = 0
    while low < len(column):
        start = column[low]
        high = np.searchsorted(column, start + COLUMNS)
        part = np.zeros((len(nodes), COLUMNS), np.float32)
        part[row[low:high], column[low:high] - start] = 1
        common += part @ part.T
        low = high
    common = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    found = (100 * common >= percent * union) & (groups[:, None] != groups[None, :])
    one, two = np.nonzero(np.triu(found, 1))
    return np.minimum(nodes[one], nodes[two]), np.maximum(nodes[one], nodes[two])


def _rest(members: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """Links (a, b) between members of a bucket that are in different components so far."""
    percent = like.percent

    def compare(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        lists = block.column("shingles").combine_chunks()
        edges = lists.offsets.to_numpy().astype(np.int64)
        keys = lists.values.to_numpy()[edges[0] : edges[-1]]
        nodes, groups = (block.column(n).to_numpy() for n in ("node", "component"))
        one, two = block_links(nodes, groups, keys, edges - edges[0], percent)
        return pa.table({"a": pa.array(one, pa.int64()), "b": pa.array(two, pa.int64())})

    blocks = _in_blocks(members).join(sets, "node")
    return (
        blocks.select("bucket", "one", "two", "node", "component", "shingles")
        .groupBy("bucket", "one", "two")
        .applyInArrow(compare, "a bigint, b bigint")
        .distinct()
    )


def grouped(documents: DataFrame, like: Likeness = CONTRACT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    documents = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketch = stored(_sketch(documents, like), "sketch")
    named = sketch.filter("n > 0 and doc_id is not null")
    classes = stored(
        named.groupBy("digest_a", "digest_b", "n").agg(F.min("doc_id").alias("node")), "classes"
    )
    banded = (
        named.filter("bands is not null")
        .join(classes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
        .select(F.col("doc_id").alias("node"), "n", F.explode("bands").alias("bucket"))
    )
    buckets = (
        banded.groupBy("bucket")
        .agg(F.min(F.struct("node", "n")).alias("least"), F.max("node").alias("last"))
        .filter("last > least.node")
        .select("bucket", F.col("least.node").alias("pivot"), F.col("least.n").alias("pivot_n"))
    )
    members = stored(banded.join(buckets, "bucket"), "buckets")
    star = stored(
        members.filter("node <> pivot")
        .filter(like.sizes_fit(F.col("n"), F.col("pivot_n")))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        .distinct(),
        "star-pairs",
    )
    in_buckets = members.select(F.col("node").alias("doc_id")).distinct()
    sets = stored(_sets(documents.join(in_buckets, "doc_id", "left_semi"), like.width), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        return pairs.filter(like.linked(F.col("common"), F.col("union"))).select("a", "b")

    one_each = star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    compared = stored(_compared(one_each, sets, like), "compared")
    links = linked(compared)
    found = stored(components(links), "components")
    apart = stored(_apart(star, found).join(compared, ["a", "b"], "left_anti"), "star-apart")
    if not apart.isEmpty():
        compared = stored(compared.union(_compared(apart, sets, like)), "compared")
        links = linked(compared)
        found = stored(components(links), "components")

    of_pivot = found.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_component"))
    placed = (
        members.join(found, "node", "left")
        .join(of_pivot, "pivot", "left")
        .select(
            "bucket",
            "node",
            F.coalesce("component", "node").alias("component"),
            F.coalesce("pivot_component", "pivot").alias("pivot_component"),
        )
    )
    more = stored(_rest(stored(placed, "placed"), sets, like), "open-links")
    if not more.isEmpty():
        found = stored(components(links.union(more)), "components")

    ids = sketch.select("doc_id", "n", "digest_a", "digest_b")
    return (
        ids.join(classes, ["digest_a", "digest_b", "n"], "left")
        .join(found, "node", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def deduplicated(documents: DataFrame, like: Likeness = STANDARD) -> DataFrame:
    """``documents`` with one document of each group, and all without an id.

    The one with the smallest id stays. Where ids are repeated, every row with an id is
    judged by its own text: rows are numbered for that in the order of their ids, so no text
    is lost because another one has its id.
    """
    key = next(n for n in (f"row_key{'_' * i}" for i in range(len(documents.columns) + 1)) if n not in documents.columns)
    named = documents.filter("doc_id is not null")
    repeated = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if repeated.isEmpty():
        rows = named.withColumn(key, F.col("doc_id").cast("bigint"))
    else:
        order = [F.col("doc_id"), F.xxhash64("text")]
        placed = named.repartitionByRange(*order).sortWithinPartitions(*order)
        # written, so that a row keeps its number whenever it is read
        rows = stored(placed.withColumn(key, F.monotonically_increasing_id()), "numbered")
    keep = grouped(rows.select(F.col(key).alias("doc_id"), "text"), like)
    kept = keep.filter("kept").select(F.col("doc_id").alias(key))
    named = rows.join(kept, key, "left_semi")
    return named.select(*documents.columns).union(documents.filter("doc_id is null"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents").select("doc_id", "text"), CONTRACT)


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM words
), grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common WHERE 100 * i >= 85 * (na + nb - i)
  UNION SELECT b, a FROM common WHERE 100 * i >= 85 * (na + nb - i)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON s.doc_id = r.a
"""
