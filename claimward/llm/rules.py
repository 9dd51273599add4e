"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Every rule looks at counts of a whole text and votes good, bad or not at all. Documents
that pass the base are counted per vote pattern (at most 3 to the number of rules), and
expectation-maximisation over the pattern counts estimates how often each rule is right on
good and on bad documents and how many documents are good. The posterior probability of
"good" replaces the rule that every check must pass.

A null text has no words: all counts are 0 and it fails the base. An empty table gives an
empty result. Repeated rows and repeated lines count like any other; extra columns are left
out. Window counts compare 64-bit hashes of words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimward.llm.common import stored, table
from claimward.llm.texts import chunks, per_text, windows, word_hashes

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_upper", "n_digits", "n_short_words", "n_closed_lines", "n_marks",
)
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\r\x0b\x0c"
CLOSED = b".!?"


@dataclass(frozen=True)
class Rule:
    """Votes good up to ``good``, bad from ``bad`` on, and abstains in between.

    ``value`` is a share of two counts. With ``good`` above ``bad`` the sense is reversed.
    """

    name: str
    part: str
    whole: str
    good: float
    bad: float

    def vote(self) -> Column:
        value = F.try_divide(F.col(self.part).cast("double"), F.col(self.whole).cast("double"))
        good, bad = (
            (value <= self.good, value >= self.bad)
            if self.good < self.bad
            else (value >= self.good, value <= self.bad)
        )
        return F.when(good, 1).when(bad, -1).otherwise(0).cast("int")


RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.02, 0.10),
    Rule("repeated_windows", "n_repeat_words", "n_words", 0.10, 0.30),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.05, 0.30),
    Rule("capitals", "n_upper", "n_letters", 0.10, 0.40),
    Rule("digits", "n_digits", "word_chars", 0.03, 0.15),
    Rule("letters", "n_letters", "word_chars", 0.90, 0.75),
    Rule("short_words", "n_short_words", "n_words", 0.20, 0.10),
    Rule("marks", "n_marks", "n_words", 0.02, 0.20),
    Rule("closed_lines", "n_closed_lines", "n_lines", 0.80, 0.30),
)


def _flags(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)], np.uint8)


#: First byte of a code point; a space; a symbol; a capital; a digit.
_IS = {
    "start": _flags(lambda b: b & 0xC0 != 0x80),
    "space": _flags(lambda b: b in SPACE),
    "symbol": _flags(lambda b: b in SYMBOLS),
    "upper": _flags(lambda b: 65 <= b <= 90),
    "digit": _flags(lambda b: 48 <= b <= 57),
    # every code point above ASCII counts as a letter
    "letter": _flags(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC0),
}


def count_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of some texts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    edges = np.concatenate([[0], np.cumsum(lengths + 1)])  # each text with a line end
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    of = {name: per_text(flags[raw], edges) for name, flags in _IS.items()}
    split = [t.split() for t in texts]
    hashes, starts = word_hashes(split)
    sizes = np.fromiter((len(w) for words in split for w in words), np.int64, len(hashes))
    space = _IS["space"][raw].astype(bool)
    first = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))  # first bytes of words
    solid = _IS["letter"][raw] | _IS["digit"][raw]
    marks = np.add.reduceat(solid, first, dtype=np.int64) == 0 if len(first) else np.zeros(0, bool)
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    return {
        "n_words": np.diff(starts),
        "word_chars": of["start"] - of["space"],
        "n_symbols": of["symbol"],
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": repeated_words(hashes, starts),
        "n_lines": np.array([len(x) for x in lines], np.int64),
        "n_letters": of["letter"],
        "n_upper": of["upper"],
        "n_digits": of["digit"],
        "n_short_words": per_text((sizes <= 3).astype(np.uint8), starts),
        "n_marks": per_text(marks, starts),  # words without letter or digit
        "n_closed_lines": np.array(
            [sum(x.rstrip()[-1] in CLOSED for x in group) for group in lines], np.int64
        ),
    }


def repeated_words(hashes: np.ndarray, starts: np.ndarray, width: int = 3) -> np.ndarray:
    """Per text, the words inside windows of ``width`` words that the text has more than once."""
    keys, owner, at = windows(hashes, starts, width)
    marked = np.zeros(len(hashes) + width, bool)
    if len(keys):
        order = np.lexsort((keys, owner))
        keys, owner, at = keys[order], owner[order], at[order]
        same = (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1])
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        for k in range(width):
            marked[at[again] + k] = True
    return per_text(marked[: len(hashes)].astype(np.uint8), starts)


def counted(documents: DataFrame) -> DataFrame:
    """Counts of every document."""
    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)

    def run(batches):
        for batch in batches:
            for keys, texts in chunks(batch.column("doc_id"), batch.column("text")):
                found = count_texts(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64())] + [pa.array(found[c], pa.int64()) for c in COUNTS],
                    names=["doc_id", *COUNTS],
                )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, schema)


def estimate(votes: np.ndarray, weights: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Log odds of good: a constant, and per rule what a bad and a good vote add.

    Each rule has an accuracy on good and on bad documents; a rule that abstains says
    nothing. Accuracies start at 0.8 with a prior of that mean worth 1 % of the documents
    (ten at least); on good documents they stay above one half, which keeps "good" from
    changing its meaning. Most rules see only one kind of bad document and rightly end up
    with a low accuracy on the others.
    """
    n_rules, total = votes.shape[1], max(float(weights.sum()), 1.0)
    strength = max(10.0, 0.01 * total)
    prior, right = 0.8, np.full((n_rules, 2), 0.8)  # columns: on bad, on good documents
    added = np.zeros((n_rules, 2))
    constant = 0.0
    for _ in range(rounds):
        right = np.stack([right[:, 0].clip(0.3, 0.995), right[:, 1].clip(0.5, 0.995)], 1)
        # votes: bad, good
        added = np.stack([np.log((1 - right[:, 1]) / right[:, 0]), np.log(right[:, 1] / (1 - right[:, 0]))], 1)
        constant = math.log(prior / (1 - prior))
        odds = constant + (votes < 0) @ added[:, 0] + (votes > 0) @ added[:, 1]
        good = 1 / (1 + np.exp(-odds.clip(-50, 50)))
        on_good, on_bad = weights * good, weights * (1 - good)
        before, prior_before = right, prior
        right = np.stack(
            [
                (on_bad @ (votes < 0) + 0.8 * strength) / (on_bad @ (votes != 0) + strength),
                (on_good @ (votes > 0) + 0.8 * strength) / (on_good @ (votes != 0) + strength),
            ],
            1,
        )
        prior = float((on_good.sum() + 0.8 * strength) / (total + strength))
        prior = min(max(prior, 0.01), 0.99)
        if np.abs(right - before).max() + abs(prior - prior_before) < 1e-9:
            break
    return constant, added


def judged(documents: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """Counts, votes, base_failed, quality (posterior) and kept of every document."""
    counts = stored(counted(documents), "rule-counts")
    names = [f"vote_{r.name}" for r in rules]
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    voted = counts.select(
        "*", base_failed.alias("base_failed"), *[r.vote().alias(n) for r, n in zip(rules, names)]
    )
    patterns = voted.filter("not base_failed").groupBy(*names).agg(F.count(F.lit(1)).alias("documents")).collect()
    votes = np.array([[row[n] for n in names] for row in patterns], np.int64).reshape(-1, len(names))
    constant, added = estimate(votes, np.array([row.documents for row in patterns], float))
    odds = F.lit(constant)
    for n, (bad, good) in zip(names, added.tolist()):
        odds = odds + F.when(F.col(n) < 0, bad).when(F.col(n) > 0, good).otherwise(0.0)
    return voted.withColumn("quality", 1 / (1 + F.exp(-odds))).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(documents).select("doc_id", *COUNTS[:5], "base_failed", "kept", "quality")
