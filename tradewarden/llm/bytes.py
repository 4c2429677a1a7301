"""Strings as flat byte arrays: views on Arrow buffers, and copies of many segments into one buffer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes that are placed with one pair of index arrays.
BLOCK = 1 << 20


def flat(strings: pa.StringArray | pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings on end, and the offsets at which they begin and end; NULL holds no bytes."""
    n = len(strings)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int32)[strings.offset:strings.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
    """out[at[i]:at[i] + lengths[i]] = data[starts[i]:starts[i] + lengths[i]] for all i, by index arrays over blocks of bytes."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    for lo in range(0, total, BLOCK):
        hi = min(lo + BLOCK, total)
        first, last = np.searchsorted(ends, [lo, hi - 1], side="right")
        begin = ends[first:last + 1] - lengths[first:last + 1]
        here = np.minimum(ends[first:last + 1], hi) - np.maximum(begin, lo)
        i = np.arange(lo, hi)
        out[i + np.repeat(at[first:last + 1] - begin, here)] = data[i + np.repeat(starts[first:last + 1] - begin, here)]


def strings(offsets: np.ndarray, data: np.ndarray) -> pa.StringArray:
    """An Arrow array over finished buffers, without a copy."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
