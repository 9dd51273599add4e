"""Spelling variants of words by a trie that is walked as a table of states.

Occurrences are counted inside the tasks first. The prefixes of all words are the nodes of a
trie, kept as a table of edges (node, letter, child), partitioned by depth. Every word walks
it as a set of states (word, position, node, edits): a state without an edit may follow its
own letter, or spend the one edit on another letter (replace), on a further letter of the
trie (insert) or on passing over a letter (delete); a state with an edit only follows its
own letters. All states at one depth of the trie are joined with the edges of that depth at
once, level by level, and a state that uses up its word at the end of another word is a
neighbour. A branch is kept only if its next letter leads on.

Two words one edit apart are equal up to the middle of the first or from there on, so each
word starts in the middle: in a trie of words with the edit behind it, and in a trie of
reversed words with the edit before it. States near the root, where every letter leads on
and every word would meet in one node, do not arise.

Nodes are 64-bit hashes of their prefix; a neighbour is confirmed on the full words. There
are as many levels as letters in the longest word up to ``LEVELS``. Longer words, where
prefixes would add up to the square of their length, meet by the hash of what remains when
one letter is left out: exact as well, one row per letter.

Defined cases: a null text has no words, a null doc_id counts as empty text before the
colon. Repeated rows count each time, with the same letter left out. An empty table, or one
without words, gives an empty result. Other columns of the table are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimward.llm.common import stored, table
from claimward.llm.texts import chunks

RUN = re.compile("[a-zÀ-ÿ]+")
EVERY = 97
SHORTEST = 5
RAREST = 3
DOMINANCE = 2
#: Words up to this many letters walk the trie.
LEVELS = 40
#: Different words counted in a task before their counts are handed on.
KEPT_WORDS = 200_000
#: Marks a node that ends a word among the letters that follow it.
END = "."


def occurrences(key: str, text: bytes) -> Iterator[tuple[str, int]]:
    """Words of a text with their counts, some with one letter left out."""
    seed = zlib.crc32(f"{key}:".encode())
    # bytes.lower() changes A-Z alone
    for run, n in Counter(RUN.findall(text.lower().decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), seed)
        if h % EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= SHORTEST:
            yield run, n


def word_counts(documents: DataFrame, id_column: str = "doc_id", rarest: int = RAREST) -> DataFrame:
    """(word, n) of all words with at least ``rarest`` occurrences."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for keys, texts in chunks(batch.column(0), batch.column(1)):
                for key, text in zip(keys, texts):
                    for word, n in occurrences("" if key is None else str(key), text):
                        counts[word] = counts.get(word, 0) + n
                if len(counts) > KEPT_WORDS:
                    yield pa.RecordBatch.from_arrays([list(counts), pa.array(counts.values(), pa.int64())], schema=schema)
                    counts = {}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema
        )

    return (
        documents.select(id_column, "text")
        .mapInArrow(run, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= rarest)
    )


def node_of(way: Column, prefix: Column) -> Column:
    return F.xxhash64(way, prefix)


def oriented(words: DataFrame) -> DataFrame:
    """Every word forwards (way 0) and reversed (way 1), with its length and first depth."""
    length = F.length("word")
    half = F.floor(length / 2).cast("int")
    forwards = words.select(
        F.xxhash64("word").alias("id"), F.lit(0).alias("way"), F.col("word").alias("text"), half.alias("start")
    )
    backwards = words.select(
        F.xxhash64("word").alias("id"), F.lit(1).alias("way"), F.reverse("word").alias("text"), (length - half).alias("start")
    )
    return forwards.union(backwards)


def trie(sides: DataFrame) -> DataFrame:
    """The edge table: depth, node, letter, child, and the letters that lead on from the child.

    ``follows`` of a child that ends a word holds ``END`` as well.
    """
    at = F.explode(F.sequence(F.lit(0), F.length("text") - 1))
    steps = sides.select("way", "text", at.alias("depth"))
    prefix = F.substring("text", F.lit(1), F.col("depth"))
    longer = F.substring("text", F.lit(1), F.col("depth") + 1)
    after = F.substring("text", F.col("depth") + 2, F.lit(1))
    letter = F.substring("text", F.col("depth") + 1, F.lit(1))
    return (
        steps.select(
            "depth",
            node_of(F.col("way"), prefix).alias("node"),
            letter.alias("letter"),
            node_of(F.col("way"), longer).alias("child"),
            F.when(after == "", END).otherwise(after).alias("after"),
        )
        .groupBy("depth", "node", "letter", "child")
        .agg(F.concat_ws("", F.array_sort(F.collect_set("after"))).alias("follows"))
    )


def _next(rest: Column) -> Column:
    """The letter a state needs next, or the end of a word."""
    letter = F.substring(rest, F.lit(1), F.lit(1))
    return F.when(letter == "", END).otherwise(letter)


def _without(rest: Column, n: int) -> Column:
    return F.substring(rest, F.lit(n + 1), F.length(rest))


def branches(states: DataFrame, edges: DataFrame) -> DataFrame:
    """What states without an edit become on the edges of their depth.

    A state that passes over a letter follows its next letter in the same step, so every
    state that results is one level deeper, or at the end of its word.
    """
    kids = edges.groupBy("node").agg(F.collect_list(F.struct("letter", "child", "follows")).alias("kids"))
    moved = states.join(kids, "node").select("id", "rest", F.explode("kids").alias("kid"))
    rest, letter, follows = F.col("rest"), F.col("kid.letter"), F.col("kid.follows")
    first = F.substring(rest, F.lit(1), F.lit(1))
    second = F.substring(rest, F.lit(2), F.lit(1))

    def move(when: Column, after: Column, edits: int) -> Column:
        keep = when & F.contains(follows, _next(after))
        return F.when(keep, F.struct(after.alias("rest"), F.lit(edits).alias("edits")))

    own = (first != "") & (letter == first)
    options = [
        F.when(own, F.struct(_without(rest, 1).alias("rest"), F.lit(0).alias("edits"))),
        move((first != "") & (letter != first), _without(rest, 1), 1),
        # among equal letters in a row, the edit is one behind the last of them
        move(letter != first, rest, 1),
        move((second != "") & (letter == second) & (first != second), _without(rest, 2), 1),
    ]
    return (
        moved.withColumn("to", F.explode(F.array(*options)))
        .filter("to is not null")
        .select("id", F.col("kid.child").alias("node"), "to.rest", "to.edits")
    )


def walked(states: DataFrame, edges: DataFrame) -> DataFrame:
    """What states with an edit become: they follow their own letters."""
    letter = F.substring("rest", F.lit(1), F.lit(1))
    after = _without(F.col("rest"), 1)
    own = edges.select("node", F.col("letter").alias("own_letter"), "child", "follows")
    return (
        states.withColumn("own_letter", letter)
        .join(own, ["node", "own_letter"])
        .filter(F.contains("follows", _next(after)))
        .select("id", F.col("child").alias("node"), after.alias("rest"), "edits")
    )


def trie_pairs(words: DataFrame) -> list[DataFrame]:
    """(id, node) tables: a word and the end node of a word one edit away, level by level."""
    sides = stored(oriented(words.filter(F.length("word") <= LEVELS)), "oriented")
    edges = stored(trie(sides).hint("rebalance", "depth"), "trie", "depth")
    deepest = sides.agg(F.max(F.length("text"))).first()[0] or 0
    node = node_of(F.col("way"), F.substring("text", F.lit(1), F.col("start")))
    rest = F.substring("text", F.col("start") + 1, F.length("text"))
    starts = sides.select("start", "id", node.alias("node"), rest.alias("rest"), F.lit(0).alias("edits"))
    entering = stored(starts.hint("rebalance", "start"), "entering", "start")
    # a word that ends one letter before its own end: the last letter is passed over
    ends = [_shorter(sides)]
    frontier = None
    for depth in range(deepest):
        level = edges.filter(F.col("depth") == depth).drop("depth")
        now = entering.filter(F.col("start") == depth).drop("start")
        if frontier is not None:
            now = now.unionByName(frontier.filter("not (edits = 1 and rest = '')"))
        reached = branches(now.filter("edits = 0"), level).union(walked(now.filter("edits = 1"), level))
        frontier = stored(reached, f"states-{depth + 1}")
        ends.append(frontier.filter("edits = 1 and rest = ''").select("id", "node"))
    return ends


def _shorter(sides: DataFrame) -> DataFrame:
    """States that pass over the last letter of their word, at the node before it."""
    before = F.substring("text", F.lit(1), F.length("text") - 1)
    return sides.select("id", node_of(F.col("way"), before).alias("node"))


def _left_out(word: str) -> Iterator[tuple[int, int]]:
    """(place, hash) of the word without the letter at each place; place -1 is the whole word."""
    prime, base = (1 << 61) - 1, 1_000_003
    letters = [ord(c) + 1 for c in word]
    behind, power = [0], [1]
    for c in reversed(letters):
        behind.append((behind[-1] + c * power[-1]) % prime)
        power.append(power[-1] * base % prime)
    behind.reverse()
    yield -1, behind[0]
    ahead = 0
    for i, c in enumerate(letters):
        rest = len(letters) - i - 1
        yield i, (ahead * power[rest] + behind[i + 1]) % prime
        ahead = (ahead * base + c) % prime


def long_pairs(words: DataFrame) -> DataFrame:
    """Candidate pairs (word, near) of words of which one is longer than ``LEVELS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word in batch.column(0).to_pylist():
                places, hashes = zip(*_left_out(word))
                yield pa.RecordBatch.from_pydict(
                    {
                        "word": pa.array([word], pa.string()),
                        "places": pa.array([places], pa.list_(pa.int32())),
                        "hashes": pa.array([hashes], pa.list_(pa.int64())),
                    }
                )

    each = words.filter(F.length("word") >= LEVELS).select("word")
    cut = stored(
        each.mapInArrow(run, "word string, places array<int>, hashes array<bigint>")
        .select(F.xxhash64("word").alias("id"), F.length("word").alias("size"), F.explode(F.arrays_zip("places", "hashes")).alias("cut"))
        .select("id", "size", F.col("cut.places").alias("place"), F.col("cut.hashes").alias("hash"))
        .distinct(),
        "letters-left-out",
    )
    a, b = cut.alias("a"), cut.alias("b")
    replaced = a.filter("place >= 0").join(
        b.filter("place >= 0"),
        F.expr("a.hash = b.hash and a.place = b.place and a.size = b.size and a.id <> b.id"),
    )
    whole = a.filter("place = -1").join(b.filter("place >= 0"), F.expr("a.hash = b.hash and a.size = b.size - 1"))
    one_way = whole.select(F.col("a.id").alias("id"), F.col("b.id").alias("near_id"))
    other = one_way.select(F.col("near_id").alias("id"), F.col("id").alias("near_id"))
    return replaced.select(F.col("a.id").alias("id"), F.col("b.id").alias("near_id")).union(one_way).union(other).distinct()


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near and its best near word (form, form_n) of every word that has near words."""
    by_id = words.select(F.xxhash64("word").alias("id"), "word", "n")
    near_id = words.select(F.xxhash64("word").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    ends = oriented(words.filter(F.length("word") <= LEVELS)).select(
        node_of(F.col("way"), F.col("text")).alias("node"),
        F.when(F.col("way") == 1, F.reverse("text")).otherwise(F.col("text")).alias("near"),
    )
    reached = None
    for pairs in trie_pairs(words):
        reached = pairs if reached is None else reached.union(pairs)
    hits = reached.join(ends, "node").select("id", F.xxhash64("near").alias("near_id"))
    # two ways may lead to one word; hashes that agree by chance fail the comparison
    near = F.struct((-F.col("near_n")).alias("less_n"), "near")
    return (
        hits.union(long_pairs(words))
        .join(by_id, "id")
        .join(near_id, "near_id")
        .filter(F.levenshtein("word", "near", 1) == 1)
        .groupBy("word", "n")
        .agg(F.collect_set(near).alias("nears"))  # at most some thousand: the one-edit strings of a word
        .select(
            "word",
            "n",
            F.size("nears").cast("bigint").alias("n_near"),
            F.array_min("nears").alias("best"),
        )
        .select("word", "n", "n_near", F.col("best.near").alias("best"), (-F.col("best.less_n")).alias("best_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words with a form: forms followed to the last, in doubling steps."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = now.join(further, "root", "left")
        now = stored(longer.select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        if now.filter("further is not null").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(documents: DataFrame, id_column: str = "doc_id", rarest: int = RAREST) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = stored(word_counts(documents, id_column, rarest), "words")
    near = stored(near_words(words), "near-words")
    formed = F.col("best_n") >= DOMINANCE * F.col("n")
    forms = near.filter(formed).select("word", F.col("best").alias("form"), F.col("best_n").alias("form_n"))
    last = roots(forms)
    return (
        words.join(near.select("word", "n_near"), "word", "left")
        .join(forms, "word", "left")
        .join(last, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            "form_n",
        )
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
