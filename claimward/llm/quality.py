"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. Its features are binned shares of character classes,
word lengths, marks at word and line ends, repetition within the line and of earlier lines and
the place in the text, each taken for the line itself and for the lines before and after it. Lines learn the
label of their document. Forward-backward gives the probability of a good line; the mean
over a text, weighted by line length, goes through a fitted logistic curve, so that scores
are probabilities of label 1.

Learning takes at most ``SAMPLE`` labelled rows per label, in the order of a hash of the id,
each with its whole text.

A null or empty text is one empty line. Labels that are null or not 0 or 1 are left out, of
repeated labels of one document the smallest counts. Without any label every score is 0.5.
Repeated rows get equal results; the filter keeps all columns as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimward.llm.common import bucket, sample_ids, table
from claimward.llm.crf import Chain, fit
from claimward.llm.texts import give_back, mixed, per_text, runs, windows, word_hashes

SAMPLE = 1_000
THRESHOLD = 0.3
HOLD_OUT = 5
HELD = 0
BINS = 12
#: Bytes of text scored at once; a longer text is scored alone.
PIECE_BYTES = 512 << 10
SPACE = b" \t\n\r\x0b\x0c"


def _flags(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)], np.uint8)


_CLASSES = {
    "space": _flags(lambda b: b in SPACE),
    "upper": _flags(lambda b: 65 <= b <= 90),
    "letter": _flags(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 0x80),
    "digit": _flags(lambda b: 48 <= b <= 57),
    "symbol": _flags(lambda b: b in b"#*$%&<>{}[]=+_~^\\/@"),
    "bar": _flags(lambda b: b == 124),
    "call": _flags(lambda b: b in b"!?"),
    "stop": _flags(lambda b: b in b".,;:"),
}
_SHARE_EDGES = np.array([0.0, 0.01, 0.03, 0.06, 0.1, 0.15, 0.25, 0.4, 0.6, 0.8, 0.95])
_LENGTH_EDGES = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16])
_COUNT_EDGES = np.array([0, 1, 2, 3, 5, 8, 12, 20, 40, 80, 160])
KINDS = 17
BUCKETS = 3 * KINDS * BINS + 1


@dataclass
class Model:
    table: np.ndarray
    chain: Chain
    slope: float
    offset: float


def line_bins(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binned features of all lines (lines, kinds), where each text's lines begin, lengths."""
    lines, counts, again = [], [], []
    for text in texts:
        own = text.split(b"\n")
        lines.extend(own)
        counts.append(len(own))
        seen: set[bytes] = set()
        for line in own:
            again.append(line in seen and bool(line.strip()))
            seen.add(line)
    total = len(lines)
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    sizes = np.fromiter(map(len, lines), np.int64, total)
    edges = np.concatenate([[0], np.cumsum(sizes + 1)])
    raw = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    of = {name: per_text(flags[raw], edges) for name, flags in _CLASSES.items()}
    is_space = _CLASSES["space"][raw].astype(bool)
    word_start = ~is_space & np.concatenate([[True], is_space[:-1]])
    is_letter = _CLASSES["letter"][raw].astype(bool)
    odd = ~is_letter & ~is_space & (_CLASSES["stop"][raw] == 0)
    odd_end = odd & np.concatenate([is_space[1:], [True]])  # a word that ends in an odd mark
    words = per_text(word_start, edges)
    ends = per_text(odd_end, edges)
    solid = sizes + 1 - of["space"]
    solid = np.maximum(solid, 0)
    first = np.fromiter((line.lstrip()[:1].isupper() for line in lines), bool, total)
    last = np.fromiter((line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines), bool, total)
    place = np.arange(total) - np.repeat(starts[:-1], counts)
    from_end = np.repeat(np.array(counts), counts) - 1 - place

    def binned(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.searchsorted(edges, values, side="left").astype(np.uint8)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return binned(_SHARE_EDGES, part / np.maximum(whole, 1))

    hashes, firsts = word_hashes([line.split() for line in lines])
    after_same = np.zeros(len(hashes), np.uint8)
    after_same[1:] = hashes[1:] == hashes[:-1]
    after_same[firsts[:-1][np.diff(firsts) > 0]] = 0
    columns = [
        share(per_text(after_same, firsts), words),
        share(repeated_windows(hashes, firsts), words),
        share(of["upper"], of["letter"]),
        share(of["letter"], solid),
        share(of["digit"], solid),
        share(of["symbol"], solid),
        share(of["bar"], words),
        share(of["call"], words),
        share(of["stop"], words),
        share(ends, words),
        binned(_LENGTH_EDGES, solid / np.maximum(words, 1)),
        binned(_COUNT_EDGES, words),
        binned(_COUNT_EDGES, np.repeat(np.array(counts), counts)),
        np.array(again, np.uint8),
        (first + 2 * last).astype(np.uint8),
        ((place == 0) + 2 * (from_end == 0)).astype(np.uint8),
        np.minimum(place, 4).astype(np.uint8),
    ]
    return np.stack(columns, 1), starts, sizes


def repeated_windows(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Per line, the two-word windows that the line has more than once, first included."""
    keys, owner, _ = windows(hashes, firsts, 2)
    keys = mixed(keys + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(keys) else np.zeros(0, bool)
    return np.bincount(owner[order][again], minlength=len(firsts) - 1)


def line_features(bins: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """Feature numbers of every line, one array per kind of the line and of its neighbours."""
    total = len(bins)
    is_first = np.zeros(total, bool)
    is_first[starts[:-1]] = True
    is_last = np.zeros(total, bool)
    is_last[starts[1:] - 1] = True
    none = BUCKETS - 1
    for kind in range(KINDS):
        yield bins[:, kind] + kind * np.int64(BINS)
    for kind in range(KINDS):
        before = np.full(total, none)
        before[1:] = bins[:-1, kind] + (KINDS + kind) * np.int64(BINS)
        before[is_first] = none
        yield before
    for kind in range(KINDS):
        after = np.full(total, none)
        after[:-1] = bins[1:, kind] + (2 * KINDS + kind) * np.int64(BINS)
        after[is_last] = none
        yield after


def line_scores(table: np.ndarray, bins: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the weights of every line's features.

    Kind by kind: the features of all lines at once take 51 numbers a line, which is gigabytes
    for a text of a few megabytes with many short lines.
    """
    scores = np.zeros((len(bins), table.shape[1]))
    for features in line_features(bins, starts):
        scores += table[features]
    return scores


def good_share(table: np.ndarray, chain: Chain, texts: list[bytes]) -> np.ndarray:
    """Length-weighted probability of good lines per text."""
    bins, starts, sizes = line_bins(texts)
    prob = chain.marginals(line_scores(table, bins, starts), starts)[:, 1]
    weight = np.where(np.repeat(per_text(sizes, starts), np.diff(starts)) > 0, sizes, 1)
    sums = np.add.reduceat(prob * weight, starts[:-1])
    return (sums / np.add.reduceat(weight, starts[:-1])).clip(0, 1)


def _log_odds(share: np.ndarray) -> np.ndarray:
    share = share.clip(1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def learn(texts: list[bytes], labels: list[int]) -> Model | None:
    if not texts:
        return None
    bins, starts, _ = line_bins(texts)
    features = np.stack(list(line_features(bins, starts)), 1).ravel()
    owner = np.repeat(np.arange(len(bins)), 3 * KINDS)
    gold = np.repeat(np.array(labels), np.diff(starts))
    kinds = np.arange(len(gold))
    weights, chain = fit(features, owner, kinds, gold, starts, 2, BUCKETS, rounds=60, rate=0.1, penalty=1e-4)
    slope, offset = _curve(_log_odds(good_share(weights, chain, texts)), np.array(labels, float))
    return Model(weights, chain, slope, offset)


def _curve(x: np.ndarray, y: np.ndarray, rounds: int = 500) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, by Newton steps with a small penalty."""
    slope, offset = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(slope * x + offset).clip(-30, 30)))
        g = np.array([((y - p) * x).sum() - 1e-2 * (slope - 1), (y - p).sum() - 1e-2 * offset])
        w = p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(h, g).clip(-1, 1)
        slope, offset = max(slope + step[0], 1e-3), offset + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(offset)


def predict(model: Model | None, texts: list[bytes]) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    x = model.slope * _log_odds(good_share(model.table, model.chain, texts)) + model.offset
    return 1 / (1 + np.exp(-x.clip(-30, 30)))


def train(documents: DataFrame, labels: DataFrame, each: int = SAMPLE) -> Model | None:
    """Model from texts and the labels of rows that are not held out."""
    usable = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter(F.col("quality").isin(0, 1) & (bucket(F.col("doc_id"), HOLD_OUT) != HELD))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    picked = sample_ids(usable.withColumnRenamed("quality", "label"), each)
    found = (
        documents.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")  # at most two times ``each`` rows
        .orderBy("doc_id", "text")
        .collect()
    )
    return learn([(r.text or "").encode() for r in found], [r.label for r in found])


def _with_score(documents: DataFrame, model: Model | None, carried: list[str], name: str) -> DataFrame:
    """``carried`` columns, as they are, and the score as column ``name``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(*carried) if "text" in carried else documents.select(*carried, "text")
    fields = ", ".join(f"`{n}` {t}" for n, t in documents.select(*carried).dtypes)

    def rated(batch):
        for low, group in runs(batch.column("text"), PIECE_BYTES):
            part = [batch.column(n).slice(low, len(group)) for n in carried]
            scores = pa.array(predict(shared.value, group), pa.float64())
            yield pa.RecordBatch.from_arrays([*part, scores], names=[*carried, name])

    def run(batches):
        for batch in batches:
            yield from rated(batch)
            give_back()

    return rows.mapInArrow(run, f"{fields}, `{name}` double")


def scored(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every document."""
    return _with_score(documents, model, ["doc_id"], "score")


def good_only(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` with a score of at least ``threshold``."""
    name = "score"
    while name in documents.columns:
        name = f"{name}_"
    rated = _with_score(documents, train(documents, labels), documents.columns, name)
    return rated.filter(F.col(name) >= threshold).drop(name)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, table(spark, sf_dir, "labels"))
    held = F.coalesce(bucket(F.col("doc_id"), HOLD_OUT) == HELD, F.lit(False))
    return scored(documents, model).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
