"""Greedy suppression of overlapping boxes in numpy over an Arrow column, many images side by side.

Boxes come in order of preference. They are taken in blocks: of each image the next few. A block's boxes are compared with
those kept before that share a cell of the image's grid, and what is left with each other; so a pile of copies is
compared with the one that stayed, and boxes far apart never meet."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64


def clash(rule: str, most: float, kept: np.ndarray, box: np.ndarray) -> np.ndarray:
    """Which pairs clash: cover, the share of the box that the kept one covers, counting pixels inclusively, above most; iou, at
    and above most."""
    more = 1 if rule == "cover" else 0
    w = np.maximum(np.minimum(kept[:, 2], box[:, 2]) - np.maximum(kept[:, 0], box[:, 0]) + more, 0)
    h = np.maximum(np.minimum(kept[:, 3], box[:, 3]) - np.maximum(kept[:, 1], box[:, 1]) + more, 0)
    area = lambda b: (b[:, 2] - b[:, 0] + more) * (b[:, 3] - b[:, 1] + more)
    with np.errstate(divide="ignore", invalid="ignore"):
        if rule == "cover":
            return w * h / area(box) > most
        both = area(kept) + area(box) - w * h
        return np.where(both > 0, w * h / both, 0.0) >= most


def _cells(boxes: np.ndarray, image: np.ndarray, side: np.ndarray):
    """(image, cell) keys of all cells that each box touches, a pixel around it, and the box of each."""
    lo = np.floor((boxes[:, :2] - 1) / side[image, None]).astype(np.int64)
    size = np.floor((np.maximum(boxes[:, 2:], boxes[:, :2]) + 1) / side[image, None]).astype(np.int64) - lo + 1
    n = size.prod(1)
    box = np.repeat(np.arange(len(boxes)), n)
    nth = np.arange(len(box)) - np.repeat(np.cumsum(n) - n, n)
    x, y = lo[box, 0] + nth % size[box, 0], lo[box, 1] + nth // size[box, 0]
    key = sum(v.astype(np.uint64) * np.uint64(odd) for v, odd in ((image[box], 0x9E3779B97F4A7C15), (x, 0xC2B2AE3D27D4EB4F), (y, 0x165667B19E3779F9)))
    return key, box


def keep(images: pa.Array, rule: str, most: float) -> pa.Array:
    """For each image's boxes (structs of x1, y1, x2, y2, the preferred first) whether they stay."""
    if isinstance(images, pa.ChunkedArray):
        images = images.combine_chunks()
    offsets = images.offsets.to_numpy().astype(np.int64)
    values = images.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    boxes = np.stack([values.field(c).to_numpy(zero_copy_only=False).astype(float) for c in range(4)], 1) if len(values) else np.zeros((0, 4))
    n = np.diff(offsets)
    image = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(boxes)) - offsets[:-1][image]
    extent = np.nan_to_num(np.maximum(boxes[:, 2] - boxes[:, 0], boxes[:, 3] - boxes[:, 1]))
    mean = np.bincount(image, extent, len(n)) / np.maximum(n, 1)
    largest = np.zeros(len(n))
    np.maximum.at(largest, image, extent)
    side = np.maximum(np.maximum(mean, largest / 8), 1.0)
    stays_ = np.ones(len(boxes), bool)
    known = ~np.isnan(boxes).any(1)  # a box without corners clashes with none
    if most < 0 or (rule == "iou" and most <= 0):
        stays_ = nth == 0  # everything clashes, near or far
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(stays_))
    order = np.lexsort((nth, nth // BLOCK))
    edges = np.append(np.flatnonzero(np.diff(nth[order] // BLOCK, prepend=-1)), len(order))
    kept_keys, kept_boxes = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        block = np.sort(order[a:b])
        block = block[known[block]]
        keys, own = _cells(boxes[block], image[block], side)
        lo, hi = np.searchsorted(kept_keys, keys), np.searchsorted(kept_keys, keys, "right")
        with_kept = np.repeat(np.arange(len(keys)), hi - lo)
        other = kept_boxes[np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())]
        gone = own[with_kept][(image[other] == image[block[own[with_kept]]]) & clash(rule, most, boxes[other], boxes[block[own[with_kept]]])]
        stays_[block[gone]] = False
        left = block[stays_[block]]
        # Pairs within the block, the preferred first, of one image.
        start = np.searchsorted(image[left], image[left])
        before = np.arange(len(left)) - start
        second = np.repeat(np.arange(len(left)), before)
        first = np.repeat(start - np.cumsum(before) + before, before) + np.arange(before.sum())
        bad = clash(rule, most, boxes[left[first]], boxes[left[second]])
        first, second = first[bad], second[bad]
        state = np.zeros(len(left), np.int8)  # 0 open, 1 stays, 2 goes
        while len(first):
            waits = np.zeros(len(left), bool)
            waits[second] = True
            state[(state == 0) & ~waits] = 1
            state[second[state[first] == 1]] = 2
            live = (state[second] == 0) & (state[first] != 2)
            first, second = first[live], second[live]
        stays_[left[state == 2]] = False
        left = left[state != 2]
        here = np.isin(block[own], left)
        kept_keys, kept_boxes = np.concatenate([kept_keys, keys[here]]), np.concatenate([kept_boxes, block[own[here]]])
        by_key = np.argsort(kept_keys, kind="stable")
        kept_keys, kept_boxes = kept_keys[by_key], kept_boxes[by_key]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(stays_))


def stays(images: Column, rule: str, most: float) -> Column:
    """Whether each of an image's boxes stays."""
    return F.arrow_udf(lambda x: keep(x, rule, most), "array<boolean>")(images)
