"""Language, quality and rules: counts against plain versions, held-out accuracy, odd rows."""

import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_tables import SF_DIR, documents  # noqa: F401
from hypothesis import given, settings, strategies as st

from claimward.llm import langid, quality, rules
from claimward.llm.crf import Chain
from claimward.llm.texts import runs

SF01 = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    marked = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in lines:
        again += line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(marked)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é#|\n\t .\u00a0\u3000𝄞", max_size=60), max_size=6))
def test_counts_equal_plain_version(texts):
    found = rules.count_texts([t.encode() for t in texts]) if texts else None
    for i, text in enumerate(texts):
        assert tuple(int(found[c][i]) for c in rules.COUNTS[:5]) == plain_counts(text)


def test_rules_on_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = rules.op6(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, lines, repeats = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (r.base_failed and r.kept) and 0 <= r.quality <= 1


def test_estimate_recovers_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.7
    right = np.array([0.9, 0.8, 0.75, 0.6])
    votes = np.where(rng.random((20_000, 4)) < right, good[:, None], ~good[:, None]) * 2 - 1
    votes[rng.random((20_000, 4)) < 0.3] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    constant, added = rules.estimate(patterns, counts.astype(float))
    odds = constant + (votes < 0) @ added[:, 0] + (votes > 0) @ added[:, 1]
    assert ((odds > 0) == good).mean() > 0.85
    assert np.all(np.diff(added[:, 1]) < 0.2)  # better rules weigh more


def test_rules_odd_rows(documents):
    rows = [(1, None), (2, ""), (None, "a b"), (4, "word " * 60_000), (5, "word " * 60_000)]
    found = {r.doc_id: r for r in rules.judged(documents(rows)).collect()}
    assert found[1].n_words == 0 and found[1].base_failed and not found[1].kept
    assert found[4].n_repeat_words == 60_000 and found[4].quality == found[5].quality
    assert rules.judged(documents(rows).filter("false")).count() == 0


def brute_marginals(chain, scores):
    """Probabilities by summing over all label sequences."""
    import itertools

    n, labels = scores.shape
    total, out = 0.0, np.zeros((n, labels))
    for path in itertools.product(range(labels), repeat=n):
        value = chain.first[path[0]] + scores[range(n), path].sum()
        value += sum(chain.moves[a, b] for a, b in zip(path, path[1:]))
        total += np.exp(value)
        out[range(n), path] += np.exp(value)
    return out / total


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(5)
    chain = Chain(rng.normal(size=(3, 3)), rng.normal(size=3))
    sizes = [4, 1, 6, 0, 3]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(size=(starts[-1], 3)) * 2
    found, pairs, first = chain.marginals(scores, starts, pairs=True)
    for a, b in zip(starts, starts[1:]):
        if b > a:
            assert np.allclose(found[a:b], brute_marginals(chain, scores[a:b]))
    assert np.isclose(pairs.sum(), sum(max(s - 1, 0) for s in sizes)) and np.isclose(first.sum(), 4)


def held_out(key, modulus, value):
    return zlib.crc32(str(key).encode()) % modulus == value


def test_language_on_held_out_rows(spark):
    gold = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = langid.op1(spark, SF01).collect()
    assert len(rows) == len(gold)
    assert all(r.held_out == held_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == gold[r.doc_id] for r in tested]) > 0.98


@pytest.fixture(scope="module")
def two_languages():
    return langid.learn(
        ["the quick brown fox and the dog\nthe cat".encode(), "der schnelle braune fuchs und der hund".encode()] * 3,
        ["en", "de"] * 3,
    )


def test_switch_inside_a_line(two_languages):
    labeller = langid.Labeller(two_languages)
    prob, _ = labeller.words([b"the quick brown fox und der braune hund"])
    best = [two_languages.labels[k] for k in prob.argmax(1)]
    assert best == ["en"] * 4 + ["de"] * 4


def test_language_odd_rows(documents, two_languages):
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "the " * 50_000), (None, "der hund"), (4, "the fox"), (6, "日本")]
    found = [(r.doc_id, r.lang_pred) for r in langid.identified(documents(rows), two_languages).collect()]
    assert found[:6] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "de"), (4, "en")]
    assert found[6][1] in ("en", "de")
    assert {r.lang_pred for r in langid.identified(documents(rows), None).collect()} == {"und"}
    assert langid.train(documents(rows).filter("false")) is None
    assert langid.train(documents([(1, None)])) is None


def test_quality_on_held_out_rows(spark):
    gold = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = quality.op9(spark, SF01).collect()
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(r.held_out == held_out(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in gold]
    assert np.mean([r.predicted == gold[r.doc_id] for r in tested]) > 0.95


def test_quality_odd_rows(spark, documents):
    good, bad = "A plain line of words.\nAnother one here.", "$$$ ### ||| !!!\n$$$ ### ||| !!!"
    docs = documents([(i, good if i % 2 else bad) for i in range(40)] + [(90, None), (91, ""), (None, good), (93, bad * 20_000)])
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(40)] + [(3, None, 0), (5, 7, 0), (999, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    kept = quality.good_only(docs, labels)
    assert kept.columns == docs.columns
    found = {r.doc_id for r in kept.collect()}
    assert {1, 3, 39, None} <= found and not found & {0, 2, 38, 93}
    assert quality.good_only(docs.filter("false"), labels).count() == 0
    scores = {r.score for r in quality.scored(docs, quality.train(docs, labels.filter("false"))).collect()}
    assert scores == {0.5}


def test_sample_is_bounded_per_label(spark):
    from claimward.llm.common import sample_ids

    ids = spark.range(5_000).selectExpr("id AS doc_id", "if(id % 50 = 0, 'rare', 'often') AS label")
    found = sample_ids(ids, 120).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in found} == {"rare": 100, "often": 120}
    again = sample_ids(ids.repartition(7), 120).collect()
    assert sorted(again) == sorted(sample_ids(ids, 120).collect())
    assert sample_ids(ids.filter("false"), 5).count() == 0


def test_quality_memory_follows_the_text():
    """Many short lines: scoring takes a bounded number of bytes a line, not all features at once."""
    model = quality.Model(np.zeros((quality.BUCKETS, 2)), Chain.blank(2), 1.0, 0.0)
    lines = 40_000
    text = b"\n" * lines
    quality.predict(model, [text])
    tracemalloc.start()
    try:
        quality.predict(model, [text])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 600 * lines


def test_quality_scores_are_sums_of_all_features():
    rng = np.random.default_rng(3)
    weights = rng.normal(size=(quality.BUCKETS, 2))
    bins, starts, _ = quality.line_bins([b"One two.\nthree 4\n\nOne two.", b"", b"\n|| !?", b"x" * 500])
    none = quality.BUCKETS - 1
    plain = np.zeros((len(bins), 2))
    for low, high in zip(starts[:-1], starts[1:]):
        for line in range(low, high):
            for part, at in enumerate((line, line - 1, line + 1)):
                for kind in range(quality.KINDS):
                    inside = low <= at < high
                    plain[line] += weights[
                        (part * quality.KINDS + kind) * quality.BINS + int(bins[at, kind]) if inside else none
                    ]
    assert np.array_equal(quality.line_scores(weights, bins, starts), plain)


def test_runs_hold_every_text_once():
    texts = pa.array(["ab", None, "", "cdefgh", "i", "jk"])
    found = list(runs(texts, 4))
    assert [low for low, _ in found] == [0, 3, 4]
    assert [t for _, group in found for t in group] == [b"ab", b"", b"", b"cdefgh", b"i", b"jk"]
