"""Spelling variants against a plain search over all words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm_tables import SF_DIR, documents  # noqa: F401

from claimward.llm import variants


def plain_words(rows):
    counts = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                letters = list(run)
                del letters[h % len(run)]
                run = "".join(letters)
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain(rows):
    words = plain_words(rows)
    shapes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shapes[w[:i] + "*" + w[i + 1 :]].add(w)
            shapes[w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            near[w] |= shapes[w[:i] + "*" + w[i + 1 :]]
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
        near[w] |= {u for u in shapes.get(w, ()) if len(u) == len(w) + 1}
        near[w].discard(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda u: (-words[u], u), default=None)
        form[w] = best if best and words[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words.get(form[w], 0)) for w, n in words.items())


def told(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def test_variants_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert told(variants.op12(spark, SF_DIR)) == plain(rows)


def test_every_kind_and_place_of_edit(documents, monkeypatch):
    monkeypatch.setattr(variants, "LEVELS", 9)  # words on both sides of the bound, and next to it
    monkeypatch.setattr(variants, "KEPT_WORDS", 20)
    rng = random.Random(4)
    words = set()
    for size in range(5, 14):
        for _ in range(3):
            w = "".join(rng.choice("abÀéÿ") for _ in range(size))
            words.add(w)
            for i in range(size + 1):
                words |= {w[:i] + "b" + w[i:], w[:i] + "é" + w[i + 1 :], w[:i] + w[i + 1 :]}
    words |= {"a" * n for n in range(4, 16)}
    rows = [(i, " ".join(f"{w}" for w in sorted(words) if rng.random() < 0.6)) for i in range(12)]
    assert told(variants.variants(documents(rows))) == plain(rows)


def test_odd_texts(documents):
    long = "x" * 30_000
    rows = [
        (1, None), (2, ""), (3, "1234 .-."), (None, "Nameless nameless NAMELESS namelesS"),
        (4, "straße straße Straße strasse strasse strasse"), (5, "ÉTUDE Étude étude étude étude ÉtuDe"),
        (6, f"{long} {long} {long} {long}y {long}y {long}y z{long[1:]} z{long[1:]} z{long[1:]}"),
        (7, "don't don't don't don't naïve naïve naïve naive naive naive naive naive naive"),
        (7, "don't don't don't don't naïve naïve naïve naive naive naive naive naive naive"),
        (8, "word\nword\tword words words words Words " * 400), (9, "ab abc abcd " * 5),
        (-3, "negative negative negative negativ negativ negativ negativv negativv negativv"),
    ]
    assert told(variants.variants(documents(rows))) == plain(rows)
    assert told(variants.variants(documents([]))) == []
    assert told(variants.variants(documents([(1, None), (2, "a b c")]))) == []


def test_letters_are_left_out_where_the_checksum_says(documents):
    rows = [(i, "alphabet Alphabet alphabeT omega") for i in range(400)]
    counts = plain_words(rows)
    assert len([w for w in counts if len(w) == 7]) > 0 and counts["alphabet"] < 1200
    assert told(variants.variants(documents(rows))) == plain(rows)


@pytest.mark.parametrize("word", ["abcde", "aaaaa", "é" * 50])
def test_hash_of_what_remains(word):
    found = dict(variants._left_out(word))
    assert set(found) == set(range(-1, len(word)))
    for i in range(len(word)):
        assert dict(variants._left_out(word[:i] + word[i + 1 :]))[-1] == found[i]


def test_long_chain_of_forms(documents):
    words = ["a" * i + "b" * (12 - i) for i in range(8)]
    rows = [(i, " ".join([w] * 3 * 2**i)) for i, w in enumerate(words)]
    found = {r.word: r for r in variants.variants(documents(rows)).collect()}
    assert {found[w].root for w in words} == {words[-1]}
    assert [found[w].form for w in words] == words[1:] + [None]
