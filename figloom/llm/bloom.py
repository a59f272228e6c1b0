"""A blocked Bloom filter of 64-bit hashes: built by Spark in parts, of a fixed number of bytes, probed with numpy."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figloom.llm.textblocks import mix

WORDS = 8


def bits(h: np.ndarray, blocks: int):
    """Block of each hash, and the mask of each of the block's eight words."""
    h = h.view(np.uint64)
    block = ((h >> np.uint64(40)) * np.uint64(blocks)) >> np.uint64(24)
    masks = np.stack([np.uint64(1) << (((h & np.uint64(0xFFFFFFFF)) * np.uint64(2 * k + 0x5BD1E995)) >> np.uint64(9) & np.uint64(63)) for k in range(WORDS)], 1)
    return block.astype(np.int64), masks


def build(keys: DataFrame, hashed: Column, filter_bytes: int, seed: int | None = None) -> np.ndarray:
    """Blocks of eight words over all keys, scrambled first where a seed is given; filter_bytes at most reach the driver,
    however many keys there are."""
    blocks = max(1, filter_bytes // (8 * WORDS))
    schema = "block long, " + ", ".join(f"w{k} long" for k in range(WORDS))

    def partial(batches):
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            block, masks = bits(h if seed is None else mix(h, seed), blocks)
            order = np.argsort(block, kind="stable")
            block, masks = block[order], masks[order]
            first = np.flatnonzero(np.diff(block, prepend=-1))
            if len(first):
                words = np.bitwise_or.reduceat(masks, first, axis=0).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block[first]), *(pa.array(np.ascontiguousarray(words[:, k])) for k in range(WORDS))], ["block", *(f"w{k}" for k in range(WORDS))])

    some = keys.select(hashed.alias("h")).mapInArrow(partial, schema)
    found = some.groupBy("block").agg(*(F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS))).toArrow()
    out = np.zeros((blocks, WORDS), np.uint64)
    for batch in found.to_batches():
        for k in range(WORDS):
            out[batch.column(0).to_numpy(), k] = batch.column(k + 1).to_numpy().view(np.uint64)
    return out


def may_hold(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    block, masks = bits(h, len(words))
    return ((words[block] & masks) == masks).all(1)
