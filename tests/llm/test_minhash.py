"""Groups against all pairs, links of every kind, odd rows."""

import random

import numpy as np
import pytest
from llm_tables import SF_DIR, brute, documents  # noqa: F401

from claimward.llm import minhash
from claimward.llm.components import components


def made_rows(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    rows = []
    for base in range(12):
        words = [word() for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(rng.randrange(1, 7)):
            copy = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
            if rng.random() < 0.3:
                words = copy  # chains of links
    shared = [word() for _ in range(40)]
    rows += [" ".join(shared + [word() for _ in range(20)]) for _ in range(15)]
    rows += ["", "  \n", "one", "one", "one two", "ONE two", "a b c", None, "é É", "x\u00a0y"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("like", [minhash.CONTRACT, minhash.STANDARD])
def test_groups_equal_all_pairs(documents, like):
    rows = made_rows(3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.grouped(documents(rows), like).collect()}
    assert found == brute(rows, like.width, like.percent)


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.op2(spark, SF_DIR).collect()}
    assert found == brute(rows, 3, 85)


@pytest.mark.parametrize("block", [2, 512])
def test_open_members_of_a_bucket_are_compared(spark, monkeypatch, block):
    """Members outside the component of the smallest meet each other and all others, once."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(4)
    base = [rng.getrandbits(60) for _ in range(100)]
    changed = lambda k, by: base[: 100 - k] + [by * 1000 + i for i in range(k)]
    sets = {1: base, 2: changed(40, 2), 3: changed(40, 2)[:-2] + [7, 8], 4: changed(7, 4), 5: changed(7, 4)[:92] + [9] * 1, 6: changed(60, 6), 7: base[:99] + [5]}
    sets = {k: sorted(set(v)) for k, v in sets.items()}
    inside = {1, 4, 7}
    members = spark.createDataFrame(
        [(1, k, 1 if k in inside else k, 1) for k in sets], "bucket bigint, node bigint, component bigint, pivot_component bigint"
    )
    table = spark.createDataFrame(list(sets.items()), "node bigint, shingles array<bigint>")
    found = {(r.a, r.b) for r in minhash._rest(members, table, minhash.CONTRACT).collect()}
    wanted = set()
    for a in sets:
        for b in sets:
            one, two = set(sets[a]), set(sets[b])
            if a < b and not {a, b} <= inside and 100 * len(one & two) >= 85 * len(one | two):
                wanted.add((a, b))
    assert found == wanted and len(wanted) >= 3


def test_deduplicated_keeps_columns_and_rows_without_id(documents):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (7, None), (8, "")]
    docs = documents(rows)
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 7, 8]
    turned = docs.select(*reversed(docs.columns))
    kept = minhash.deduplicated(turned)
    assert kept.columns == turned.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 7, 8]


def test_empty_table(documents, spark):
    none = documents([(1, "a")]).filter("false")
    assert minhash.grouped(none).count() == 0 and minhash.deduplicated(none).count() == 0


def test_repeated_rows_and_a_long_text(documents):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(9_000)}" for _ in range(60_000))
    found = minhash.grouped(documents([(9, long), (4, long + " end"), (9, long), (2, "short text")])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == [
        (2, 2, True), (4, 4, True), (9, 4, False), (9, 4, False)
    ]


def test_unlike_texts_under_one_id_stay(documents):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    near = one.replace("a39", "z")
    rows = [(1, one), (1, two), (1, one), (2, near), (3, two + " more"), (4, None), (4, ""), (4, "few words"), (None, one)]
    kept = minhash.deduplicated(documents(rows)).collect()
    texts = [r.text for r in kept if r.doc_id is not None]
    assert len([t for t in texts if t in (one, near)]) == 1
    assert len([t for t in texts if t in (two, two + " more")]) == 1
    assert sorted(map(str, (t for t in texts if not t or len(t) < 10))) == ["", "None", "few words"]
    assert [r.text for r in kept if r.doc_id is None] == [one]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 2**63, 500).astype(np.uint64)
    other = np.concatenate([one[:450], rng.integers(0, 2**63, 50).astype(np.uint64)])
    count = minhash.CONTRACT.bands * minhash.ROWS
    signed = minhash.signatures(np.concatenate([one, other]), np.array([0, 500, 1000]), count, minhash.permutations(count))
    assert abs((signed[:, 0] == signed[:, 1]).mean() - 450 / 550) < 0.1


def test_block_counts_are_exact(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = random.Random(9)
    sets = [sorted(rng.sample(range(60), rng.randrange(30, 60))) for _ in range(25)]
    edges = np.cumsum([0] + [len(x) for x in sets])
    one, two = minhash.block_links(np.arange(25), np.arange(25), np.concatenate(sets), edges, 60)
    wanted = {
        (i, j) for i in range(25) for j in range(i + 1, 25)
        if 100 * len(set(sets[i]) & set(sets[j])) >= 60 * len(set(sets[i]) | set(sets[j]))
    }
    assert set(zip(one.tolist(), two.tolist())) == wanted and wanted


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    links = spark.createDataFrame(chain + star + [(7, 3), (100, 101), (200, 200)], "a bigint, b bigint")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components(links.filter("false")).count() == 0
