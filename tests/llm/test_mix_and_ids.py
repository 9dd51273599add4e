"""Water-filling against a plain version, token files against the tokenizer, the pipeline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_tables import SF_DIR, brute, documents  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from claimward.llm import mixing, tokens
from claimward.llm.common import folder
from claimward.llm.minhash import STANDARD


def plain_targets(sizes):
    """Targets per source by clamping and sharing again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, clamped = 1.5 * sum(sizes.values()), set()
    while True:
        left = budget - sum(2 * sizes[s] for s in clamped)
        total = sum(weight[s] for s in order if s not in clamped)
        target = {s: 2 * sizes[s] if s in clamped else left * weight[s] / total for s in order}
        over = {s for s in order if s not in clamped and target[s] > 2 * sizes[s]}
        if not over:
            return target
        clamped |= over


def check_mix(rows, texts):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r, (source, text) in zip(rows, texts):
        assert r.size == len((text or "").encode().split()) and r.taken <= 2 * r.size
        sizes[source] += r.size
        taken[source] += r.taken
        target[source] = (r.target, r.source_size)
    wanted = plain_targets(dict(sizes))
    for source in sizes:
        assert target[source] == (pytest.approx(wanted[source]), sizes[source])
        assert abs(taken[source] - wanted[source]) <= 0.02 * sizes[source] + 40
    return sum(taken.values())


def test_mix_of_the_table(spark):
    docs = {r.doc_id: (r.source, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = sorted(mixing.op10(spark, "/root/testdata/sf0.01").collect(), key=lambda r: r.doc_id)
    check_mix(rows, [docs[r.doc_id] for r in rows])
    again = sorted(mixing.op10(spark, "/root/testdata/sf0.01").collect(), key=lambda r: r.doc_id)
    assert rows == again


def test_rows_without_id_are_drawn_one_by_one(spark):
    data = [(None if i % 3 else 7, f"{i} " + "w " * (1 + i % 30), "a" if i % 2 else None) for i in range(900)]
    table = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    mixed = mixing.mix(table, budget=0.5, epochs=2)
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    assert words(mixed.collect()) == pytest.approx(0.5 * words(table.collect()), rel=0.02)


def test_mix_with_a_hot_null_and_empty_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_DOCS", 50)
    kinds = [None] * 200 + ["b"] * 60 + ["ä"] * 30 + ["z"] * 5 + ["a"] * 9
    data = [(i, "w " * (1 + i * 7 % 90) if k != "a" else None, k) for i, k in enumerate(kinds)] + [(0, "w " * 5, "b")]
    table = spark.createDataFrame([(*r, 1, 2) for r in data], "doc_id bigint, text string, source string, size int, slice int")
    sized, per_source, drawn = mixing._planned(table, 1.5, 2, 17, "doc_id")
    by_source = defaultdict(lambda: [0, 0])
    for r in mixing.repetitions(sized, per_source, drawn).collect():
        by_source[r.source][0] += r.size
        by_source[r.source][1] += r.size * r.times
    wanted = plain_targets({s: v[0] for s, v in by_source.items()})
    for s, (size, taken) in by_source.items():
        assert abs(taken - wanted[s]) <= 0.02 * size + 60
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(v[1] for v in by_source.values())
    assert mixing.mix(table.filter("false")).count() == 0
    assert mixing.mix(table.filter("source = 'a'")).count() == 0


ODD = [
    "", " ", "Hello, World!", "it's we'll THEY'RE", "a\x0bb\x0cc\x1cd\x85e\u00a0f", "e\u0301 E\u0301x. \u0301", "ΑΣ ΑΣ. Σ",
    "12 3.4 5,6!!! x$$$ $$$", "<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|>", "日本語。テスト ﬁne", "x" * 5000, "don't.' '...",
    "a.b,c;d: e's's", "İstanbul ß ẞ", "\u200b zero\u200bwidth", "𝄞 music😀!!", "tab\tnew\r\nline",
]


def expected_ids(texts):
    tokenizer = Tokenizer.from_file(tokens.VOCABULARY)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_encoder_equals_the_library():
    encoder = tokens.Encoder(tokens.VOCABULARY)
    found = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode([t.encode() for t in ODD])]
    assert found == expected_ids(ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aB.,!'s|$ \n\té\u0301Σ1日<>😀\u00a0\x1f", max_size=25), max_size=5))
def test_encoder_equals_the_library_on_any_text(texts):
    encoder = tokens.Encoder.of(tokens.VOCABULARY)
    found = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode([t.encode() for t in texts])]
    assert found == expected_ids(texts)


def test_simple_words_go_to_the_merges_and_are_remembered(monkeypatch):
    encoder = tokens.Encoder(tokens.VOCABULARY)
    encoder.tokenizer = None  # normalizing and cutting are not needed for these
    texts = ["The caf\u00e9 \u00f6ffnet um,", "word.,!! \u00fcber|$%&*#;: straße\n\nx", " a  A\t", "zzqxy" * 400]
    found = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode([t.encode() for t in texts])]
    assert found == expected_ids(texts)
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 0)
    encoder.merges = None  # a new memory is begun, and the one before still answers
    found = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode([t.encode() for t in texts])]
    assert found == expected_ids(texts)


def check_ids(rows, texts):
    at = 0
    for r, ids in zip(rows, expected_ids(texts)):
        ids = np.array([*ids, 1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_ids_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    rows = sorted(tokens.op8(spark, SF_DIR).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs]
    check_ids(rows, [d.text for d in docs])


def test_odd_rows_and_single_frames(spark, documents):
    data = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (None, None), (3, "again")]
    index = tokens.write(documents(data), folder(spark, "t"), frame_tokens=20)
    rows = sorted(tokens.positions(index, tokens.read(index)).collect(), key=lambda r: r.start)
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    assert [r.doc_id for r in rows] == [i for i, _ in order]
    check_ids(rows, [t for _, t in order])
    one = tokens.read(index.filter("doc_id = 2"), with_ids=True).first()
    assert one.ids == [*expected_ids([ODD[2]])[0], 1]
    assert tokens.encoded(documents(data).filter("false")).count() == 0


def test_files_follow_the_seekable_format(spark, documents):
    import struct

    import zstandard

    rows = documents([(i, "some words here") for i in range(90)])
    index = tokens.write(rows, folder(spark, "t"), frame_tokens=10)
    name = index.first().file.removeprefix("file:")
    raw = open(name, "rb").read()
    frames, flag, magic = struct.unpack("<IBI", raw[-9:])
    assert (flag, magic) == (0x80, 0x8F92EAB1) and frames > 1
    assert struct.unpack("<I", raw[-9 - 12 * frames - 8 :][:4])[0] == 0x184D2A5E
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(plain) == 2 * sum(r.n_tokens for r in index.filter(F.col("file") == index.first().file).collect())


def test_pipeline_stage_by_stage(spark):
    """Every stage on the rows its predecessor kept, against plain versions."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_classifier"](spark, docs, SF_DIR)
    assert good.columns == docs.columns and 0 < good.count() < docs.count()

    rows = [(r.doc_id, r.text) for r in good.collect()]
    groups = brute(rows, STANDARD.width, STANDARD.percent)
    unique = stages["near_dedup"](spark, good, SF_DIR)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(k for k, (_, c) in groups.items() if k == c)

    clean = stages["decontamination"](spark, unique, SF_DIR)
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in unique.collect() if any(i in r.text for i in items)}
    left = {r.doc_id for r in clean.collect()}
    assert holds and not left & holds and len(left) == unique.count() - len(holds)

    mixed = stages["source_mixing"](spark, clean, SF_DIR)
    times = Counter(r.doc_id for r in mixed.collect())
    assert max(times.values()) <= 2 and set(times) <= left and mixed.columns == docs.columns

    ids = sorted(stages["token_ids"](spark, mixed, SF_DIR).collect(), key=lambda r: r.start)
    by_id = {r.doc_id: r.text for r in clean.collect()}
    assert Counter(r.doc_id for r in ids) == times
    check_ids(ids, [by_id[r.doc_id] for r in ids])
    assert sorted(corpus_pipeline.run(spark, SF_DIR).collect()) == sorted(ids)


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
