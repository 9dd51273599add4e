"""Planted passages, whole and with substitutions, against a plain comparison."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from claimward.llm import decontaminate
from llm_tables import SF_DIR, documents  # noqa: F401

ITEMS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"),
    (2, "Red, green; blue! yellow purple orange pink brown black white grey cyan magenta teal navy olive"),
    (3, "nine words are enough for a short item here"),
    (4, "too short"),
    (5, None),
    (6, "ALPHA beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi."),
]


def benchmark(spark, items=ITEMS):
    rows = [(i, t, "x") for i, t in items]
    return spark.createDataFrame(rows, "item_id bigint, text string, doc_id string")


def test_planted_passages(spark, documents):
    rng = random.Random(2)
    filler = lambda n: " ".join(f"f{rng.randrange(500)}" for _ in range(n))
    one = ITEMS[0][1].split()
    changed = list(one)
    for k in (2, 7, 12):
        changed[k] = "other"
    rows = [
        (1, filler(50) + " " + ITEMS[0][1] + " " + filler(30)),
        (2, ITEMS[1][1].upper().replace(",", " -- ")),
        (3, filler(5) + " " + " ".join(changed)),
        (4, filler(80)),
        (5, filler(20) + " " + " ".join(one[:6]) + " " + filler(20)),
        (6, None),
        (7, ""),
        (8, filler(9) + "\n" + ITEMS[2][1] + "\n" + filler(20_000)),
        (9, "too short"),
        (None, ITEMS[0][1]),
        (4, ITEMS[0][1]),
    ]
    docs = documents(rows)
    hits = decontaminate.contaminated(docs, benchmark(spark)).collect()
    found = sorted((r.doc_id or -1, r.item_id) for r in hits)
    assert found == [(-1, 1), (1, 1), (2, 2), (3, 1), (4, 1), (8, 3)]
    kept = decontaminate.decontaminated(docs, benchmark(spark))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7, 9]


def test_empty_tables(spark, documents):
    docs = documents([(1, ITEMS[0][1])])
    none = benchmark(spark).filter("false")
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.decontaminated(docs, none).count() == 1
    assert decontaminate.contaminated(docs.filter("false"), benchmark(spark)).count() == 0


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    broadcast = decontaminate.op5(spark, SF_DIR).collect()
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert sorted(broadcast) == sorted(decontaminate.op5(spark, SF_DIR).collect())
    assert broadcast


def test_main_path_has_no_python(spark, documents):
    df = decontaminate.contaminated(documents([(1, "a")]), benchmark(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_hits(documents, items):
    """(document, item) pairs by comparing all alignments one by one."""
    found = []
    for d, text in documents:
        doc = text.split()
        for i, item in items:
            words = item.split()
            n = len(words)
            for shift in range(1 - n, len(doc)):
                agree = [0 <= shift + k < len(doc) and doc[shift + k] == words[k] for k in range(n)]
                if 10 * sum(agree) >= 6 * n or any(sum(agree[s : s + 20]) >= 16 for s in range(n - 19)):
                    found.append((d, i))
                    break
    return found


def test_every_allowed_alignment_is_found(spark, documents):
    rng = random.Random(5)
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in (8, 9, 11, 12, 16, 20, 23, 40, 59, 64, 130)]
    docs = []
    for n, item in items:
        words = item.split()
        for trial in range(30):
            keep = set(rng.sample(range(n), -(-6 * n // 10) - trial % 2))
            if trial == 2:
                keep = {k for k in range(n) if k % 5 in (0, 1, 3)}
            if trial == 3 and n > 20:
                keep = {k for k in range(3, 23) if k % 5}
            body = [w if k in keep else f"other{k}" for k, w in enumerate(words)]
            ends = [[f"f{rng.randrange(50)}" for _ in range(rng.choice((0, 1, 9)))] for _ in range(2)]
            docs.append((len(docs), " ".join(ends[0] + body + ends[1])))
        docs.append((len(docs), " ".join(words[n - -(-6 * n // 10) :])))
    hits = decontaminate.contaminated(documents(docs), benchmark(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id) for r in hits) == sorted(brute_hits(docs, items))


def test_least_triples_equals_enumeration():
    for size in range(5, 13):
        for matched in range(size + 1):
            fewest = min(
                sum(c - a <= 4 for a, _, c in combinations(places, 3))
                for places in combinations(range(size), matched)
            )
            assert decontaminate.least_triples(size, matched) == fewest
    assert min(decontaminate._least_by_size()) >= 1


def test_short_items_and_scripts_without_spaces(spark, documents):
    items = [
        (1, "a b c d e f g h"), (2, "what is the capital of Peru"), (3, "who are you"),
        (4, "中华人民共和国的首都是哪里"), (5, "ชื่อเมืองหลวงของประเทศไทย"), (6, "one two three four five"),
        (7, "Yes"), (8, "New York"), (9, "?!"), (10, None),
    ]
    docs = [
        (1, "x a b c d OTHER f g h x"), (2, "What is the capital of Peru?"), (3, "Q: what is the capital of Peru - Lima"),
        (4, "what is the capital of Chile"), (5, "Who are you?"), (6, "tell me who are you now"),
        (7, "问：中华人民共和国的首都在哪里？北京"), (8, "中华料理的做法在哪里"), (9, "x ชื่อเมืองหลวงของประเทศไทย y"),
        (10, "one two three four"), (11, "0 one two three four five"), (12, "who are"),
        (13, "yes!"), (14, "yes yes"), (15, "(New) york."), (16, "in New York"), (17, "?!"), (18, None), (19, "York New"),
    ]
    hits = decontaminate.contaminated(documents(docs), benchmark(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id) for r in hits) == [
        (1, 1), (2, 2), (3, 2), (5, 3), (7, 4), (9, 5), (11, 6), (13, 7), (15, 8)
    ]
    cut = spark.createDataFrame([("Ab3 中文字 カナ。x한국어 y",)], "t string").select(decontaminate.tokens(F.col("t"))).first()[0]
    assert cut == ["ab3", "中", "文", "字", "カ", "ナ", "x한국어", "y"]
