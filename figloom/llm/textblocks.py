"""Words of many texts at once: numpy over the bytes of an Arrow string column, in blocks of bounded size."""

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; a longer text is a block by itself.
BLOCK_BYTES = 1 << 20

#: Space and the control characters \t \n \v \f \r part words; everything else belongs to one.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but letters, digits and bytes of characters beyond ASCII parts terms.
NOT_TERM = np.array([not (chr(b).isalnum() or b >= 0x80) for b in range(256)])
#: Lower case for A-Z alone.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the splitmix64 finaliser)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, BLOCK_BYTES + 1)
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers[:] = both
    return _powers[0], _powers[1]


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES):
    """Yield (first row, last row + 1, bytes, offsets of the rows in them); nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + block_bytes, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = SPACE):
    """First byte and last byte + 1 of every word, and where each row's words begin among them (rows + 1 numbers)."""
    inside = ~parts[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from running sums of a polynomial."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * power[: len(data)], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))


def ngram_hashes(words: np.ndarray, rows: np.ndarray, n: int):
    """Hashes of every n words in a row of one text, and where each row's begin; shorter rows have none."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros_like(rows)
    grams = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        grams = mix(grams * np.uint64(0x9FB21C651E98DF25) + words[k : len(words) - n + 1 + k], k) if n <= 8 else grams * np.uint64(0x9FB21C651E98DF25) + words[k : len(words) - n + 1 + k]
    count = np.maximum(np.diff(rows) - n + 1, 0)
    at = np.concatenate([[0], np.cumsum(count)])
    index = np.repeat(rows[:-1] - at[:-1], count) + np.arange(at[-1])
    return mix(grams[index], n), at
