"""Token ids in seekable zstandard files.

Documents are range-partitioned and sorted by id. Each task encodes its documents, packs
whole documents into independent zstandard frames of about ``FRAME_TOKENS`` ids (unsigned
little-endian 16-bit numbers if the vocabulary allows, else 32-bit), and ends its file
with a skippable frame that holds the seek table: compressed size, plain size and checksum
of every frame. A reader takes the table from the end of the file and decompresses only
the frames of the documents it wants.

Null texts count as empty and hold the end id alone. Rows with equal ids are all kept,
ordered by text. A null id sorts first. Extra columns are left out.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from claimward.llm.common import attempt_name, folder, open_for_read, open_for_write, stored, table
from claimward.llm.texts import chunks, give_back

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
FRAME_TOKENS = 1 << 16
LEVEL = 3
#: Words whose ids a Python worker keeps before it begins a new memory; it also keeps the one before.
KNOWN_WORDS = 200_000
#: Bytes of text encoded at once.
PIECE_BYTES = 4 << 20

# Fixed values of the seekable zstandard format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

INDEX = (
    "doc_id bigint, part int, file string, frame int, place bigint, n_tokens bigint, part_start bigint"
)
READ = "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids_crc32 bigint"

#: Words in one call of the tokenizer.
AT_ONCE = 500
#: Closing marks that a word may be cut before: no rule of the tokenizer joins them to a letter.
CLOSING = b".,!?|$%&*#;:"
_PLAIN_END = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")

#: What a tokenizer does before its merges, if words as in ``_SIMPLE`` go to the merges as they are.
_PREPARED = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
#: Parts of a model that the merges are made of; others must be off.
_GIVEN = {"type", "vocab", "merges", "end_of_word_suffix"}
#: Lower-case letters of Latin-1, which no normalizer changes, and closing marks; one word a line.
_SIMPLE = re.compile(r"^(?:([a-z\u00df-\u00f6\u00f8-\u00ff]+)([.,!?|$%&*#;:]*)|[^\n]*)$", re.MULTILINE)
_workers: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of texts, word by word with a memory of words seen.

    The tokenizer cuts at white space and lowers case before anything else, so the ids of
    a text are those of its words in order, and ASCII capitals do not matter. Unknown words
    go to the tokenizer library, many in one call; end-of-word ids (for words of letters only)
    or offsets tell which ids belong to which. Lower-case Latin letters with closing marks are one or
    two pieces that normalizing and cutting leave as they are, so where the tokenizer prepares its
    text as in ``_PREPARED`` they go to its merges, spelled in its alphabet of bytes, without those steps.
    Special tokens are matched before case is lowered, so texts with ``<|`` keep theirs.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        self.suffix = parts["model"].get("end_of_word_suffix")
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends_word[number] = bool(self.suffix) and token.endswith(self.suffix)
        self.merges = self._merges(parts)
        self.known: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes] = {}

    def _merges(self, parts: dict):
        """The tokenizer without the steps before its merges; None if those steps are others."""
        from tokenizers import Tokenizer, models, pre_tokenizers

        model = parts["model"]
        if not self.suffix or any(parts[name] != told for name, told in _PREPARED.items()):
            return None
        if model["type"] != "BPE" or any(v for k, v in model.items() if k not in _GIVEN):
            return None
        merges = [tuple(pair) for pair in model["merges"]]
        # no word comes twice, so nothing is kept
        bare = Tokenizer(models.BPE(model["vocab"], merges, cache_capacity=0, end_of_word_suffix=self.suffix))
        bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        # the alphabet of bytes: visible ones stand for themselves, the others follow after 255
        shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        later = iter(range(256, 512))
        spelled = [chr(b) if b in shown else chr(next(later)) for b in range(256)]
        spelled[0x20] = " "
        self.alphabet = "".join(spelled)
        return bare

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in _workers:
            _workers[path] = cls(path)
        return _workers[path]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        whole = pa.array(texts, pa.binary()).cast(pa.string())
        lowered = pc.if_else(pc.match_substring(whole, "<|"), whole, pc.ascii_lower(whole))
        split = pc.ascii_split_whitespace(lowered)
        counted = split.flatten().dictionary_encode()
        words = counted.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > KNOWN_WORDS:
            self.older, self.known, self.stems = self.known, {b"": b""}, {}
        new = [word for word in words if word not in self.known]
        again = [word for word in new if word in self.older]
        if again:
            self.known.update(zip(again, map(self.older.__getitem__, again)))
            new = [word for word in new if word not in self.older]
        self._learn(self._learn_simple(new) if self.merges else new)
        found = pa.array(list(map(self.known.__getitem__, words)), pa.large_binary())
        _, ends, ids = found.take(counted.indices).buffers()
        # at the ends of texts; a gather keeps the order of words
        bounds = np.frombuffer(ends, np.int64)[split.offsets.to_numpy()].tolist()
        ids = memoryview(ids or b"")
        return [bytes(ids[low:high]) for low, high in zip(bounds, bounds[1:])]

    def _learn_simple(self, words: list[bytes]) -> list[bytes]:
        """Learn the words that need the merges only; returns the others."""
        rest = []
        for at in range(0, len(words), AT_ONCE):
            some = words[at : at + AT_ONCE]
            found = _SIMPLE.findall(b"\n".join(some).decode("utf-8"))
            simple = [word for word, (stem, _) in zip(some, found) if stem]
            if len(simple) < len(some):
                rest += [word for word, (stem, _) in zip(some, found) if not stem]
                found = [pair for pair in found if pair[0]]
            pieces = " ".join([stem + " " + marks if marks else stem for stem, marks in found])
            if not pieces.isascii():
                pieces = codecs.charmap_decode(pieces.encode("utf-8"), "strict", self.alphabet)[0]
            ids = np.array(self.merges.encode_batch_fast([pieces], add_special_tokens=False)[0].ids, "<u4")
            bounds = np.flatnonzero(self.ends_word[ids]) + 1
            last = np.cumsum([2 if marks else 1 for _, marks in found], dtype=np.int64) - 1
            if len(bounds) != (last[-1] + 1 if found else 0):
                rest += simple
                continue
            raw, highs = ids.tobytes(), (bounds[last] * 4).tolist()
            self.known.update(zip(simple, [raw[low:high] for low, high in zip([0, *highs], highs)]))
        return rest

    def _learn(self, words: Iterable[bytes]) -> None:
        cut = {}
        for word in words:
            stem = word.rstrip(CLOSING)
            parts = (word,)
            if stem and stem != word and stem[-1] in _PLAIN_END:
                parts = (stem, word[len(stem) :])
            cut[word] = parts
        new = {p for parts in cut.values() for p in parts}.difference(self.stems)
        self._ask(sorted(new))
        for word, parts in cut.items():
            self.known[word] = b"".join(self.stems[p] for p in parts)

    def _ask(self, words: list[bytes]) -> None:
        plain, other = [], []
        for word in words:
            text = word.decode("utf-8")
            (plain if self.suffix and text.isalpha() else other).append((word, text))
        for low in range(0, len(plain), AT_ONCE):
            other += self._ask_plain(plain[low : low + AT_ONCE])
        for low in range(0, len(other), AT_ONCE):
            self._ask_any(other[low : low + AT_ONCE])

    def _ask_plain(self, pairs: list[tuple[bytes, str]]) -> list[tuple[bytes, str]]:
        """Words of letters only are one piece each, so each has one end-of-word id.

        Returns the words if the count does not come out, for the slower way.
        """
        joined = " ".join(text for _, text in pairs)
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        bounds = np.flatnonzero(self.ends_word[ids]) + 1
        if len(bounds) != len(pairs):
            return pairs
        raw, low = ids.tobytes(), 0
        for (word, _), high in zip(pairs, (bounds * 4).tolist()):
            self.stems[word] = raw[low:high]
            low = high
        return []

    def _ask_any(self, pairs: list[tuple[bytes, str]]) -> None:
        if pairs:
            group, texts = [w for w, _ in pairs], [t for _, t in pairs]
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            starts = np.cumsum([0] + [len(t) + 1 for t in texts])
            first = np.array([o[0] for o in found.offsets], np.int64)
            bounds = np.searchsorted(first, starts)
            for k, word in enumerate(group):
                self.stems[word] = ids[bounds[k] : bounds[k + 1]].tobytes()


class FrameWriter:
    """One seekable file."""

    def __init__(self, out, width: str, frame_tokens: int = FRAME_TOKENS):
        self.out, self.width, self.frame_tokens = out, width, frame_tokens
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int, int]] = []
        self.pending: list[bytes] = []
        self.pending_tokens = 0

    def add(self, ids: bytes) -> tuple[int, int]:
        """Add one document; returns its frame and its place among the frame's ids."""
        if self.pending_tokens >= self.frame_tokens:
            self.flush()
        spot = (len(self.frames), self.pending_tokens)
        self.pending.append(np.frombuffer(ids, "<u4").astype(self.width).tobytes())
        self.pending_tokens += len(ids) // 4
        return spot

    def flush(self) -> None:
        if self.pending:
            plain = b"".join(self.pending)
            packed = self.packer.compress(plain)
            self.out.write(packed)
            self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
            self.pending, self.pending_tokens = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<III", *f) for f in self.frames)
        tail = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(tail)) + entries + tail)
        self.out.close()


class FrameReader:
    """Reads single frames of a seekable file."""

    def __init__(self, source, width: str):
        self.source, self.width = source, width
        self.unpacker = zstandard.ZstdDecompressor()
        source.seek(0, 2)
        end = source.tell()
        source.seek(end - 9)
        count, flag, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        source.seek(end - 9 - 12 * count)
        self.table = np.frombuffer(source.read(12 * count), "<u4").reshape(count, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])

    def frame(self, number: int) -> np.ndarray:
        packed, plain, check = (int(x) for x in self.table[number])
        self.source.seek(int(self.starts[number]))
        data = self.unpacker.decompress(self.source.read(packed), max_output_size=plain)
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {number} does not fit its checksum")
        return np.frombuffer(data, self.width)


def id_width(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def write(
    documents: DataFrame,
    base: str,
    path: str = VOCABULARY,
    end_id: int = END_ID,
    frame_tokens: int = FRAME_TOKENS,
) -> DataFrame:
    """Write the id files under ``base``; returns the stored index, one row per document."""
    width, ending = id_width(path), struct.pack("<I", end_id)
    names = ["doc_id", "frame", "place", "n_tokens", "part_start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder, file, writer, total = Encoder.of(path), None, None, 0
        for batch in batches:
            for keys, texts in chunks(batch.column("doc_id"), batch.column("text"), PIECE_BYTES):
                if writer is None:
                    file = attempt_name(base, "ids") + ".zst"
                    writer = FrameWriter(open_for_write(file), width, frame_tokens)
                rows = {n: [] for n in names}
                for key, ids in zip(keys, encoder.encode(texts)):
                    frame, place = writer.add(ids + ending)
                    size = len(ids) // 4 + 1
                    for n, v in zip(names, (key, frame, place, size, total)):
                        rows[n].append(v)
                    total += size
                count = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows["doc_id"], pa.int64()),
                        pa.array([part] * count, pa.int32()),
                        pa.array([file] * count, pa.string()),
                        pa.array(rows["frame"], pa.int32()),
                        pa.array(rows["place"], pa.int64()),
                        pa.array(rows["n_tokens"], pa.int64()),
                        pa.array(rows["part_start"], pa.int64()),
                    ],
                    names=["doc_id", "part", "file", "frame", "place", "n_tokens", "part_start"],
                )
            give_back()
        if writer is not None:
            writer.close()

    ordered = (
        documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return stored(ordered.mapInArrow(run, INDEX), "ids-index")


def read(index: DataFrame, path: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Read the documents of the given index rows back from the files.

    Each task opens the files of its rows, takes their seek tables and decompresses every
    frame it needs once. Columns: doc_id, part, part_start, n_tokens, ids_crc32 and, if
    asked for, ids.
    """
    width = id_width(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, reader, number, frame = None, None, None, -1, None
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            checks, lists = [], []
            for file, at, place, size in zip(
                columns["file"], columns["frame"], columns["place"], columns["n_tokens"]
            ):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, open_for_read(file)
                    reader, number = FrameReader(source, width), -1
                if at != number:
                    number, frame = at, reader.frame(at)
                ids = frame[place : place + size].astype("<u4")
                if len(ids) != size:
                    raise ValueError(f"frame {at} of {file} is too short")
                checks.append(zlib.crc32(ids.tobytes()))
                if with_ids:
                    lists.append(ids)
            arrays = [
                batch.column("doc_id"),
                batch.column("part"),
                batch.column("part_start"),
                batch.column("n_tokens"),
                pa.array(checks, pa.int64()),
            ]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int64) for x in lists], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
            )
        if source is not None:
            source.close()

    rows = (
        index.select("doc_id", "part", "file", "frame", "place", "n_tokens", "part_start")
        .withColumn("block", F.expr("frame div 64"))
        .repartition("file", "block")
        .sortWithinPartitions("file", "frame", "place")
        .drop("block")
    )
    return rows.mapInArrow(run, READ + (", ids array<bigint>" if with_ids else ""))


def positions(index: DataFrame, rows: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before; parts follow the order of ids.

    The running sum is over one row per file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        index.groupBy("part")
        .agg(F.sum("n_tokens").alias("tokens"))
        .select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("part_base"))
    )
    return rows.join(parts, "part").withColumn("start", F.col("part_base") + F.col("part_start"))


def encoded(documents: DataFrame) -> DataFrame:
    index = write(documents, folder(documents.sparkSession, "ids"))
    return positions(index, read(index)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))
