"""Exact top-k search by inner product, over a KD-tree per shard.

Vectors are dealt by a hash of their row to shards of a bounded number of values. Every
shard becomes one tree: median splits in the dimension of the widest spread, and tight
bounding boxes. The trees are stored; a query block (also of bounded size) is searched in a
shard best-first, that is, nodes are opened by falling upper bound of the inner product over
their box, until no bound reaches the query's kth score. All bounds of a block come from two
matrix products.

Shards are searched in rounds of 1, 2, 4, ... shards. After each round the kth score a query
has reached is handed to its block, so the following shards return only candidates that can
still be among the first k: a query's rows grow with the logarithm of the number of shards.
The kth score of any part of the candidates is never above that of all, and nodes are left
out only when strictly below it, so results are exact, ties included. In many dimensions the
boxes prune little and the work goes towards queries x rows, in blocks.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part.
Vectors are compared with those of their own length; empty ones score 0 with each other.
Scaled components are kept within 2^40; ranks follow the exact scores, and a score beyond 64
bits is returned as the nearest number of 64 bits. Rows
with equal ids are rows of their own: a query leaves out its own row alone. A row without an
id is a candidate (last among ties) and never a query. A query without candidates has no
rows. Other columns of the table are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from claimward.llm.common import stored, table
from claimward.llm.vectors import by_length, exact_dot, usable, whole

K = 20
EVERY = 20
#: Values (rows x dimensions) of a shard and of a query block.
SHARD_VALUES = 1 << 19
BLOCK_VALUES = 1 << 15
#: Vectors of a leaf.
LEAF = 256
#: Most partitions a round of searches is dealt to.
PARTITIONS = 20_000
LEAST, MOST = -(1 << 63), (1 << 63) - 1
NO_ID = MOST


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i+1, 2i+2) over permuted points."""

    points: np.ndarray
    ids: np.ndarray
    has_id: np.ndarray
    rows: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray

    PARTS = ("points", "ids", "has_id", "rows", "start", "end", "low", "high")

    def leaves(self) -> list[bool]:
        n = len(self.start)
        return [2 * i + 1 >= n or self.start[2 * i + 1] < 0 for i in range(n)]

    def packed(self) -> dict[str, bytes]:
        return {p: np.ascontiguousarray(getattr(self, p), np.int64).tobytes() for p in self.PARTS}

    @classmethod
    def unpacked(cls, size: int, parts: dict[str, bytes]) -> "Tree":
        flat = {p: np.frombuffer(parts[p], np.int64) for p in cls.PARTS}
        for p, n in (("points", len(flat["rows"])), ("low", len(flat["start"])), ("high", len(flat["start"]))):
            flat[p] = flat[p].reshape(n, size)
        return cls(**flat)


def build(points: np.ndarray, ids: np.ndarray, has_id: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Tree:
    """Split at the median of the widest dimension until a node has at most ``leaf`` points."""
    order = np.argsort(rows, kind="stable")
    nodes = {}
    todo = [(0, 0, len(order))]
    while todo:
        node, start, end = todo.pop()
        here = points[order[start:end]]
        low, high = here.min(0), here.max(0)
        nodes[node] = (start, end, low, high)
        if end - start <= leaf or not len(low) or not (high > low).any():
            continue
        widest = int(np.argmax(high - low))
        middle = (end - start) // 2
        order[start:end] = order[start:end][np.argpartition(here[:, widest], middle)]
        todo += [(2 * node + 1, start, start + middle), (2 * node + 2, start + middle, end)]
    size, dims = max(nodes) + 1, points.shape[1]
    starts, ends = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    lows, highs = np.zeros((size, dims), np.int64), np.zeros((size, dims), np.int64)
    for node, (start, end, low, high) in nodes.items():
        starts[node], ends[node], lows[node], highs[node] = start, end, low, high
    return Tree(points[order], ids[order], has_id[order], rows[order], starts, ends, lows, highs)


def box_bounds(tree: Tree, queries: np.ndarray) -> np.ndarray:
    """Largest inner product each query can have in each node's box."""
    return exact_dot(np.maximum(queries, 0), tree.high.T) + exact_dot(np.minimum(queries, 0), tree.low.T)


class Searcher:
    """One tree and one block of queries.

    Scores are doubles while every sum of products fits 53 bits, else Python integers.
    """

    def __init__(self, tree: Tree, queries: np.ndarray, k: int):
        dims = max(1, queries.shape[1])
        most = 2 * dims * int(np.abs(queries).max(initial=0)) * int(np.abs(tree.points).max(initial=0))
        kind = np.float64 if most < 1 << 53 else object
        self.tree, self.k = tree, k
        self.points, self.queries = tree.points.astype(kind), queries.astype(kind)
        self.bounds = box_bounds(tree, queries).tolist()
        self.leaves, self.starts, self.ends = tree.leaves(), tree.start.tolist(), tree.end.tolist()

    def best_first(self, number: int, own: int, reached: int | None) -> list[tuple[int, int]]:
        """(score, place) of the first k points for a query, ties by id.

        ``own`` is the query's row, ``reached`` a kth score it has from other shards. Nodes
        are opened by falling bound; the search ends at the first bound below the kth score.
        """
        query, bounds, k = self.queries[number], self.bounds[number], self.k
        heap = [(-bounds[0], 0)]
        places, scores = np.empty(0, np.int64), np.empty(0, self.points.dtype)
        while heap:
            bound, node = heapq.heappop(heap)
            if reached is not None and -bound < reached:
                break
            if not self.leaves[node]:
                for child in (2 * node + 1, 2 * node + 2):
                    if reached is None or bounds[child] >= reached:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            start, end = self.starts[node], self.ends[node]
            found = self.points[start:end] @ query
            keep = self.tree.rows[start:end] != own
            if reached is not None:
                keep &= found >= reached
            at = np.flatnonzero(keep)
            if not len(at):
                continue
            places = np.concatenate([places, start + at])
            scores = np.concatenate([scores, found[at]])
            if len(scores) >= k:
                reached = int(np.sort(scores)[-k])
                still = scores >= reached
                places, scores = places[still], scores[still]
        rows, ids, has_id = self.tree.rows, self.tree.ids, self.tree.has_id
        order = sorted((-int(s), not has_id[p], ids[p], rows[p], p) for s, p in zip(scores, places.tolist()))
        return [(-o[0], o[-1]) for o in order[:k]]


def _numbered(embeddings: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(row, vec_id, x, size) of usable vectors, written once so that row numbers stay."""
    rows = embeddings.filter(usable(F.col(vector))).select(
        F.col(id_column).cast("bigint").alias("vec_id"), whole(F.col(vector)).alias("x")
    )
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    return stored(numbered.withColumn("size", F.size("x")), "vectors")


def _slices(rows: DataFrame, most: int) -> int:
    """Into how many hash slices of about ``most`` values the rows are dealt."""
    values = rows.agg(F.coalesce(F.sum(F.col("size").cast("bigint") + 8), F.lit(0))).first()[0]
    return max(1, -(-values // most))


TREE_SCHEMA = "size int, shard bigint, " + ", ".join(f"{p} binary" for p in Tree.PARTS)
FOUND_SCHEMA = "query bigint, query_id bigint, vec_id bigint, candidate bigint, score decimal(38,0)"


def _matrix(lists) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return next(by_length(lists))[1]


def trees(rows: DataFrame, shards: int, leaf: int = LEAF) -> DataFrame:
    """One stored tree per length and shard."""

    def plant(shard: pa.Table) -> pa.Table:
        ids = shard.column("vec_id").combine_chunks()
        has_id = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
        tree = build(
            _matrix(shard.column("x")), ids.fill_null(NO_ID).to_numpy(), has_id, shard.column("row").to_numpy(), leaf
        )
        whose = {"size": pa.array([shard.column("size")[0].as_py()], pa.int32())}
        whose["shard"] = pa.array([shard.column("shard")[0].as_py()], pa.int64())
        return pa.table(whose | {p: pa.array([v], pa.binary()) for p, v in tree.packed().items()})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    return stored(dealt.groupBy("size", "shard").applyInArrow(plant, TREE_SCHEMA), "kd-trees")


def _first_k(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "candidate")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """Search every (tree, query block) row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield one({n: batch.column(n)[i] for n in batch.schema.names})

    def one(pair: dict[str, pa.Scalar]) -> pa.RecordBatch:
        tree = Tree.unpacked(pair["size"].as_py(), {p: pair[p].as_py() for p in Tree.PARTS})
        asked = pair["asked"].values
        own, reached = asked.field("row").to_numpy(), asked.field("reached").to_pylist()
        reached = [None if r is None else int(r) for r in reached]
        searcher = Searcher(tree, _matrix(asked.field("x")), k)
        hits = [(i, *hit) for i in range(len(own)) for hit in searcher.best_first(i, own[i], reached[i])]
        number, place = (np.array([h[j] for h in hits], np.int64) for j in (0, 2))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(own[number]),
                asked.field("vec_id").take(pa.array(number)),
                pa.array(tree.ids[place], mask=tree.has_id[place] == 0),
                pa.array(tree.rows[place]),
                pa.array([Decimal(h[1]) for h in hits], pa.decimal128(38, 0)),
            ],
            names=["query", "query_id", "vec_id", "candidate", "score"],
        )

    return pairs.select("size", *Tree.PARTS, "asked").mapInArrow(run, FOUND_SCHEMA)


def top_k(
    embeddings: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score of every query's ``k`` best other rows.

    ``is_query`` is a condition on ``vec_id``, the id as bigint.
    """
    rows = _numbered(embeddings, id_column, vector)
    shards = _slices(rows, SHARD_VALUES)
    planted = trees(rows, shards)
    queries = rows.filter(F.coalesce(is_query, F.lit(False)))
    blocks = _slices(queries, BLOCK_VALUES)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)))

    parts = min(2 * shards, PARTITIONS)
    found, done = None, 0
    while done < shards:
        more = min(max(1, done), shards - done)
        asking = queries.withColumn("reached", F.lit(None).cast("decimal(38,0)"))
        if found is not None:
            kth = found.filter(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("reached"))
            asking = queries.join(kth, "row", "left")
        asked = asking.groupBy("size", "block").agg(
            F.collect_list(F.struct("row", "vec_id", "reached", "x")).alias("asked")
        )
        # block b starts with shard b, so the first rounds are spread over all shards
        turn = F.sequence(F.lit(done).cast("bigint"), F.lit(done + more - 1).cast("bigint"))
        at = asked.withColumn("turn", F.explode(turn)).select(
            "size", F.pmod(F.col("block") + F.col("turn"), F.lit(shards)).alias("shard"), "asked"
        )
        # a fixed number of partitions: the work is in the pairs, not in their bytes
        placed = [side.repartition(parts, "size", "shard") for side in (planted, at)]
        now = _searched(placed[0].join(placed[1], ["size", "shard"]), k)
        if found is not None:
            now = found.drop("rank").unionByName(now)
        found = stored(_first_k(now, k), "top-k")
        done += more
    score = F.greatest(F.lit(LEAST), F.least(F.lit(MOST), "score")).cast("bigint")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0, K)


OP13_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.x, v.x) AS BIGINT) AS score
  FROM whole q JOIN whole v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 20
"""
