"""Embedding columns as whole numbers, and Arrow lists of them as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

SCALE = 64
#: Scaled components are kept within this bound, so that sums of products stay exact.
BOUND = float(1 << 40)


def usable(vector: Column) -> Column:
    """True where a vector is there and all its components are finite."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def whole(vector: Column, shift: int = 0) -> Column:
    """floor(64 * c) + shift of every component, as bigint."""

    def one(c: Column) -> Column:
        scaled = F.floor(c.cast("double") * float(SCALE))
        low, high = (F.lit(int(b)).cast("bigint") for b in (-BOUND, BOUND))
        return F.greatest(low, F.least(high, scaled)) + F.lit(shift).cast("bigint")

    return F.transform(vector, one)


def by_length(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of all lists of one length, for each length in a batch."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        same = lists if len(at) == len(lists) else lists.take(pa.array(at))
        flat = same.flatten().to_numpy(zero_copy_only=False)
        yield at, flat.astype(np.int64).reshape(len(at), int(size))


def exact_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of whole numbers: in doubles while all sums fit 53 bits, else in Python integers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a.astype(object) @ b.astype(object)
