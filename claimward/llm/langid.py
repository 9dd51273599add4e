"""Language of texts by a linear-chain conditional random field over words.

Every line is a chain of words. A word has affix features (first and last one to three
bytes), n-gram features (two and three bytes, with word ends) and a lexicon feature (the
word itself, if the learning sample has it often enough), all hashed into a table of
weights; transitions between the languages of neighbouring words are learned with them.
Forward-backward gives each word a probability per language, so that switches inside a
text show; the language of a text is the one with the largest mean over its words with a
letter, and that mean is the score.

Learning takes at most ``SAMPLE`` rows per language and ``ROWS`` in all, in the order of a
hash of the id, each with its whole text; every word counts for the language of its row.

A null text and a text without a letter get ``und`` and score 0; so does everything if
nothing can be learned. Rows with a null or empty language are not learned from. Repeated
rows get equal results; extra columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimward.llm.common import bucket, sample_ids, table
from claimward.llm.crf import Chain, fit, kind_scores
from claimward.llm.texts import chunks, mixed, per_text

SAMPLE = 150
ROWS = 6_000
BUCKETS = 1 << 17
ROUNDS = 20
#: Words whose scores a task keeps before it starts anew.
KNOWN_WORDS = 300_000
LEXICON_MIN = 3
HOLD_OUT = 3
HELD = 1


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray
    chain: Chain
    lexicon: np.ndarray  # sorted hashes of the words with a lexicon feature


def words_of(texts: list[bytes], numbers: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The number of each word in order, and where each line's words begin.

    New words are added to ``numbers``.
    """
    kinds: list[int] = []
    ends = [0]
    number = numbers.setdefault
    for text in texts:
        for line in text.lower().split(b"\n"):
            words = line.split()
            if words:
                kinds.extend([number(w, len(numbers)) for w in words])
                ends.append(len(kinds))
    return np.array(kinds, np.int64), np.array(ends, np.int64)


def word_features(words: list[bytes], lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of distinct words, and the word of each."""
    count = len(words)
    padded = [b"\x02" + w + b"\x03" for w in words]
    sizes = np.fromiter(map(len, padded), np.int64, count)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    raw = np.frombuffer(b"".join(padded) + b"\0\0\0", np.uint8).astype(np.uint64)
    total = int(edges[-1])
    owner = np.repeat(np.arange(count), sizes)
    place = np.arange(total) - edges[:-1][owner]
    left = sizes[owner] - place  # bytes from here to the end
    two = raw[:total] | (raw[1 : total + 1] << np.uint64(8))
    three = two | (raw[2 : total + 2] << np.uint64(16))
    four = three | (raw[3 : total + 3] << np.uint64(24))
    found, owners = [], []

    def add(values: np.ndarray, mask: np.ndarray, kind: int) -> None:
        found.append(mixed(values[mask] | np.uint64(kind << 40)))
        owners.append(owner[mask])

    add(two, left >= 2, 1)
    add(three, left >= 3, 2)
    add(four, (place == 0) & (left >= 4), 3)  # three first bytes
    add(four, left == 4, 4)  # three last bytes
    hashes = lexicon_hashes(words, raw, edges, owner)
    known = np.isin(hashes, lexicon, assume_unique=False) if len(lexicon) else np.zeros(count, bool)
    found.append(mixed(hashes[known] ^ np.uint64(0x5BD1E995)))
    owners.append(np.flatnonzero(known))
    found.append(np.zeros(count, np.uint64))  # one feature that all words share
    owners.append(np.arange(count))
    ids = (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64)
    return ids, np.concatenate(owners)


def lexicon_hashes(words, raw, edges, owner) -> np.ndarray:
    """64-bit hashes of words: sums of scrambled bytes with their places."""
    place = (np.arange(int(edges[-1])) - edges[:-1][owner]).astype(np.uint64)
    values = mixed(raw[: int(edges[-1])] + (place << np.uint64(8)))
    return np.add.reduceat(values, edges[:-1]) if len(words) else np.zeros(0, np.uint64)


def learn(texts: list[bytes], languages: list[str]) -> Model | None:
    labels = sorted(set(languages))
    if not labels:
        return None
    numbers: dict[bytes, int] = {}
    kinds, starts = words_of(texts, numbers)
    words = list(numbers)
    if not words:
        return None
    number = {label: i for i, label in enumerate(labels)}
    words_in = np.array([len(t.split()) for t in texts])
    gold = np.repeat([number[x] for x in languages], words_in)
    often = np.bincount(kinds, minlength=len(words)) >= LEXICON_MIN
    common = [w for w, yes in zip(words, often) if yes]
    padded = [b"\x02" + w + b"\x03" for w in common]
    sizes = np.fromiter(map(len, padded), np.int64, len(common))
    edges = np.concatenate([[0], np.cumsum(sizes)])
    raw = np.frombuffer(b"".join(padded), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(common)), sizes)
    lexicon = np.unique(lexicon_hashes(common, raw, edges, owner))
    features, owners = word_features(words, lexicon)
    weights, chain = fit(features, owners, kinds, gold, starts, len(labels), BUCKETS, rounds=ROUNDS)
    return Model(labels, weights.astype(np.float32), chain, lexicon)


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8"))


class Labeller:
    """A model with the scores of the words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.scores = np.zeros((0, len(self.model.labels)))
        self.lettered = np.zeros(0, bool)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities per word in order, and whether the word has a letter."""
        if len(self.numbers) > KNOWN_WORDS:
            self._forget()
        before = len(self.numbers)
        kinds, starts = words_of(texts, self.numbers)
        new = list(islice(self.numbers, before, None))
        if new:
            features, owners = word_features(new, self.model.lexicon)
            fresh = kind_scores(self.model.table, features, owners, len(new))
            self.scores = np.concatenate([self.scores, fresh])
            letters = np.fromiter((w.isalpha() or has_letter(w) for w in new), bool, len(new))
            self.lettered = np.concatenate([self.lettered, letters])
        return self.model.chain.marginals(self.scores[kinds], starts), self.lettered[kinds]


def predict(labeller: Labeller | None, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and score of every text."""
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    if labeller is None:
        return names, scores
    prob, lettered = labeller.words(texts)
    counts = np.fromiter((len(t.split()) for t in texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(counts)])
    total = per_text(lettered, starts)
    sums = np.zeros((len(texts), prob.shape[1]))
    for k in range(prob.shape[1]):
        run = np.concatenate([[0.0], np.cumsum(prob[:, k] * lettered)])
        sums[:, k] = run[starts[1:]] - run[starts[:-1]]
    best = sums.argmax(1)
    for i in np.flatnonzero(total):
        names[i] = labeller.model.labels[best[i]]
        scores[i] = min(max(sums[i, best[i]] / total[i], 0.0), 1.0)
    return names, scores


def sampled(documents: DataFrame, label: Column, each: int, rows: int) -> DataFrame:
    """At most ``each`` rows per label and ``rows`` in all, with label and text.

    Ids are picked first, without texts; their number is bounded by the parameters.
    """
    ids = documents.select("doc_id", label.alias("label")).filter("label is not null and doc_id is not null")
    picked = sample_ids(ids, each).select("doc_id").distinct()
    bounded = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return (
        documents.select("doc_id", label.alias("label"), "text")
        .join(F.broadcast(bounded), "doc_id")
        .filter("label is not null and text is not null")
    )


def train(documents: DataFrame, each: int = SAMPLE, rows: int = ROWS) -> Model | None:
    """Model from (doc_id, text, lang) rows."""
    language = F.when(F.trim("lang") != "", F.col("lang"))
    found = sampled(documents, language, each, rows).orderBy("doc_id", "label").collect()
    return learn([r.text.encode() for r in found], [r.label for r in found])


def identified(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        labeller = Labeller(shared.value) if shared.value else None
        for batch in batches:
            for ids, texts in chunks(batch.column("doc_id"), batch.column("text")):
                names, scores = predict(labeller, texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held = bucket(F.col("doc_id"), HOLD_OUT) == HELD
    model = train(documents.select("doc_id", "text", "lang").filter(~held))
    return identified(documents.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
