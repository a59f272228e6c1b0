"""Arrow string columns as bytes: many texts side by side for numpy, and pieces of them back as strings."""

import numpy as np
import pyarrow as pa


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column, and where each text begins among them (one number more than texts); nulls count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    """The pieces [start, stop) of data as strings."""
    size = np.maximum(stops - starts, 0)
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[at])))


def first_of_overlapping(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Of intervals by rising start those that are kept when each kept one rules out what begins before it stops."""
    n = len(starts)
    after = np.maximum(np.searchsorted(starts, stops), np.arange(n) + 1)
    keep, jumps, i = np.zeros(n, bool), np.flatnonzero(after != np.arange(n) + 1), 0
    while i < n:
        j = np.searchsorted(jumps, i)
        if j == len(jumps):
            keep[i:] = True
            break
        keep[i : jumps[j] + 1] = True
        i = after[jumps[j]]
    return keep
