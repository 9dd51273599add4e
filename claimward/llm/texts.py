"""Whole texts inside tasks: bounded pieces of a batch, words and hashes as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 2 << 20


def runs(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """First row and UTF-8 texts of runs of bounded size; a null text is empty."""
    group, size, low = [], 0, 0
    for i, text in enumerate(texts.cast(pa.binary())):
        value = text.as_py() or b""
        if group and size + len(value) > most:
            yield low, group
            group, size, low = [], 0, i
        group.append(value)
        size += len(value)
    if group:
        yield low, group


def chunks(keys: pa.Array, texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Keys and UTF-8 texts of a batch in runs of bounded size; a null text is empty."""
    ids = keys.to_pylist()
    for low, group in runs(texts, most):
        yield ids[low : low + len(group)], group


def give_back() -> None:
    """Return the memory of batches that are gone to the machine.

    Arrow keeps it for later batches, and a Python worker lives on, with other stages of the job
    beside it in the executor's memory.
    """
    pa.default_memory_pool().release_unused()


def word_hashes(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and where each text begins (one more at the end)."""
    counts = np.fromiter(map(len, split), np.int64, len(split))
    starts = np.concatenate([[0], np.cumsum(counts)])
    total = int(starts[-1])
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w) for words in split for w in words), np.uint64, total)
    return hashes, starts


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finalizer of a well-known hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def windows(hashes: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside a text, their text and first word.

    A text with fewer words has none.
    """
    counts = np.diff(starts)
    n = np.maximum(counts - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), n)
    base = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(int(base[-1])) - np.repeat(base[:-1], n) + np.repeat(starts[:-1], n)
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        out = mixed(out + hashes[at + k] + np.uint64(0x9E3779B97F4A7C15))
    return out, owner, at


def per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring starts."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]
