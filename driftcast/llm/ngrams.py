"""Hashed byte n-grams of many texts at once, and their corpus counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BITS = 16
BUCKETS = 1 << BITS


def grams(data: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at every byte (n <= 4), row by row, and the rows'
    n + 1 offsets in them; n-grams do not cross rows."""
    if len(data) < n:
        return np.zeros(0, np.uint16), np.zeros(len(bounds), np.int64)
    code = np.full(len(data) - n + 1, n, np.uint32)
    for i in range(n):
        code *= np.uint32(0x01000193)
        code ^= data[i:len(data) - n + 1 + i]
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint16)
    inside = np.ones(len(bucket) + n, bool)
    for i in range(1, n):  # the last n - 1 places of a row start no n-gram
        at = bounds[1:] - i
        inside[at[at >= bounds[:-1]]] = False
    inside = inside[:len(bucket)]
    ends = np.concatenate([[0], np.cumsum(inside)])
    return bucket[inside], ends[np.minimum(bounds, len(bucket))]


def count_rows(counts: np.ndarray, name: pa.Array | None = None) -> list[pa.Array]:
    """The buckets in use and their counts, as columns."""
    used = np.flatnonzero(counts)
    return [pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())]
