"""Whitening against a plain eigenvalue routine, top-k search against all scores."""

import math
import random

import numpy as np
import pytest
from check_oracles import compare, connect
from llm_tables import SF_DIR

from claimward.llm import catalog, kdsearch, whitening

VECTORS = "vec_id bigint, embedding array<float>, label int, n bigint, x string, row int, size int, score string"


@pytest.fixture
def embeddings(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, 1, 2, "x", 3, 4, "y") for i, v in rows], VECTORS)

    return build


def used(rows):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, [math.floor(64 * float(np.float32(c))) for c in v]) for i, v in good]


# ---- whitening


@pytest.mark.parametrize("rank", [7, 3])
def test_factor_and_rotations(rank):
    rng = np.random.default_rng(rank)
    a = rng.normal(size=(7, rank)) * [10.0 ** -i for i in range(rank)]
    matrix = a @ a.T
    lower, order = whitening.pivoted_cholesky(matrix)
    assert lower.shape == (7, rank)
    assert np.allclose(lower @ lower.T, matrix[np.ix_(order, order)], rtol=1e-12, atol=1e-15)
    assert all(abs(lower[i, i]) >= abs(lower[j, j]) for i in range(rank) for j in range(i, rank))
    columns = whitening.one_sided_jacobi(lower)
    gram = columns.T @ columns
    scale = np.sqrt(np.outer(gram.diagonal(), gram.diagonal()))
    assert np.all(np.abs(gram - np.diag(gram.diagonal())) <= 1e-14 * scale)
    values, vectors = whitening.principal(matrix)
    assert np.allclose(values, np.linalg.svd(a, compute_uv=False) ** 2, rtol=1e-9)
    assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-9)


def test_round_robin_meets_every_pair_once():
    for size in range(8):
        pairs = [(int(i), int(j)) for one, two in whitening._rounds(size) for i, j in zip(one, two)]
        assert sorted(pairs) == [(i, j) for i in range(size) for j in range(i + 1, size)]


def check_whitened(found, rows, components):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], np.int64) + whitening.SHIFT
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    width = min(components, int((values > 1e-9 * max(1, values[0])).sum()))
    assert len(found) == n * width
    deviation = {}
    for i, v in zip(ids, x.tolist()):
        deviation.setdefault(i, []).append(sum((n * int(c) - int(s)) ** 2 for c, s in zip(v, sums)))
    assert all(r.deviation in deviation[r.vec_id] and r.n == n for r in found)
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and 0 <= errors.pop() < 1e-9
    for c in range(width):
        mine = sorted((str(r.vec_id), r.whitened) for r in found if r.component == c + 1)
        wanted = centred @ vectors[:, c] / np.sqrt(values[c])
        for sign in (1, -1):
            theirs = sorted((str(i), w) for i, w in zip(ids, sign * wanted))
            if np.allclose([w for _, w in mine], [w for _, w in theirs], atol=1e-6):
                break
        else:
            raise AssertionError(f"component {c + 1}")
        shares = {r.explained for r in found if r.component == c + 1}
        assert list(shares) == [pytest.approx(values[c] / values.sum(), rel=1e-9)]


def test_whitening_of_the_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = used([(r.vec_id, r.embedding) for r in table.collect()])
    found = whitening.op11(spark, SF_DIR).collect()
    check_whitened(found, rows, 32)
    assert sorted(found) == sorted(whitening.op11(spark, SF_DIR).collect())


def test_whitening_of_odd_vectors(embeddings):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1), rng.gauss(0, 2), 0.5, rng.gauss(1, 3)]) for i in range(40)]
    rows += [(5, rows[5][1]), (None, [0.1, 0.2, 0.5, 0.3])]  # repeated row and id, null id
    odd = [(90, None), (91, [1.0, None, 0.0, 0.0]), (92, [math.nan] * 4), (93, [0.0, math.inf, 0.0, 0.0])]
    odd += [(94, []), (95, [1.0, 2.0]), (96, [1.0] * 4000)]  # other lengths
    found = whitening.whiten(embeddings(rows + odd)).collect()
    check_whitened(found, used(rows), 32)  # rank 3: the constant dimension has no component
    assert {r.component for r in found} == {1, 2, 3}


def test_whitening_without_variance_is_empty(embeddings):
    for rows in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, None)]):
        found = whitening.whiten(embeddings(rows))
        assert found.columns[:4] == ["vec_id", "component", "n", "deviation"] and found.count() == 0


def test_whitening_of_huge_components_stays_exact(embeddings):
    rows = [(i, [3e9 * (i % 7), float(i), 1e38 if i == 3 else 0.0]) for i in range(30)]
    found = whitening.whiten(embeddings(rows)).collect()
    x = [[min(1 << 40, math.floor(64 * float(np.float32(c)))) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    exact = {i: sum((30 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
    assert all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 1 << 63 else None) for r in found)
    assert {r.component for r in found} == {1, 2, 3}


# ---- search


def brute_top(rows, every, k):
    numbered = list(enumerate(rows))
    out = []
    for row, (key, v) in numbered:
        if key is None or key % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), other is None, other or 0)
            for r, (other, w) in numbered
            if r != row and len(w) == len(v)
        ]
        for rank, (score, missing, other) in enumerate(sorted(scored)[:k], 1):
            out.append((key, rank, None if missing else other, -score))
    return sorted(out, key=str)


def test_tree_boxes_are_tight_and_leaves_cover_all():
    rng = np.random.default_rng(1)
    points = rng.integers(-30, 30, (300, 5))
    tree = kdsearch.build(points, np.arange(300), np.ones(300, np.int64), np.arange(300), leaf=16)
    leaves = [i for i, leaf in enumerate(tree.leaves()) if leaf and tree.start[i] >= 0]
    spans = sorted((tree.start[i], tree.end[i]) for i in leaves)
    assert [s for s, _ in spans] == [0] + [e for _, e in spans][:-1] and spans[-1][1] == 300
    assert max(e - s for s, e in spans) <= 16
    for i in range(len(tree.start)):
        if tree.start[i] >= 0:
            part = tree.points[tree.start[i] : tree.end[i]]
            assert (part.min(0) == tree.low[i]).all() and (part.max(0) == tree.high[i]).all()
    queries = rng.integers(-30, 30, (20, 5))
    bounds = kdsearch.box_bounds(tree, queries)
    for i in leaves:
        scores = queries @ tree.points[tree.start[i] : tree.end[i]].T
        assert (scores.max(1) <= bounds[:, i]).all()


def test_search_leaves_nodes_unopened_and_takes_a_kth_score_from_elsewhere():
    rng = np.random.default_rng(2)
    points = np.repeat(rng.integers(-1000, 1000, (40, 2)), 25, axis=0) + rng.integers(-5, 5, (1000, 2))
    tree = kdsearch.build(points, np.arange(1000), np.ones(1000, np.int64), np.arange(1000), leaf=8)
    search = kdsearch.Searcher(tree, np.array([[3, 4]]), 5)
    wanted = sorted(((int(s), int(i)) for i, s in enumerate(points @ [3, 4])), key=lambda p: (-p[0], p[1]))[:5]
    assert [(s, int(tree.ids[p])) for s, p in search.best_first(0, -1, None)] == wanted
    kth = wanted[2][0]
    assert [(s, int(tree.ids[p])) for s, p in search.best_first(0, -1, kth)] == [w for w in wanted if w[0] >= kth]
    opened = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            opened.append(key)
            return np.asarray(super().__getitem__(key))

    search.points = search.points.view(Watched)
    search.best_first(0, -1, None)
    assert len(opened) < sum(tree.leaves()) / 4


def test_top_k_of_the_table(spark, monkeypatch):
    name = next(n for n in catalog.QUERIES if n.startswith("op13_"))
    assert compare(spark, connect(SF_DIR), SF_DIR, name, catalog.QUERIES[name], catalog.ORACLES[name]) == ""
    for size, value in (("SHARD_VALUES", 5000), ("BLOCK_VALUES", 700), ("LEAF", 8)):
        monkeypatch.setattr(kdsearch, size, value)  # many shards, blocks and rounds
    assert compare(spark, connect(SF_DIR), SF_DIR, name, catalog.QUERIES[name], catalog.ORACLES[name]) == ""


def test_top_k_of_odd_vectors(embeddings, monkeypatch):
    monkeypatch.setattr(kdsearch, "SHARD_VALUES", 300)
    rng = random.Random(5)
    same = [0.5, -0.25, 0.125]
    rows = [(i, same if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    rows += [(20, same), (20, [1.0, 1.0, 1.0]), (None, same), (-20, [0.3, 0.1, 0.9])]  # repeated, null, negative
    rows += [(100, [1.0, 2.0]), (101, [0.5, 0.5]), (120, [1.0] * 5000), (140, []), (141, [])]  # other lengths
    rows += [(160, None), (161, [None, 1.0, 1.0]), (180, [math.nan, 0.0, 0.0]), (181, [0.0, -math.inf, 0.0])]
    found = kdsearch.top_k(embeddings(rows), kdsearch.F.col("vec_id") % 20 == 0, 7).collect()
    assert sorted(map(tuple, found), key=str) == brute_top(used(rows), 20, 7)


def test_top_k_of_nothing_and_of_huge_components(embeddings):
    condition = kdsearch.F.col("vec_id") % 20 == 0
    assert kdsearch.top_k(embeddings([]), condition).collect() == []
    assert kdsearch.top_k(embeddings([(1, [1.0]), (2, [2.0])]), condition).collect() == []
    assert kdsearch.top_k(embeddings([(20, [1.0])]), condition).collect() == []
    rows = [(i, [1e9 * i, 1e9, float(i)]) for i in range(25)]
    found = kdsearch.top_k(embeddings(rows), condition, 5).collect()
    most = (1 << 63) - 1
    wanted = [(q, r, v, min(s, most)) for q, r, v, s in brute_top(used(rows), 20, 5)]
    assert sorted(map(tuple, found), key=str) == wanted
