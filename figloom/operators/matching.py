"""Greedy matching of predictions to truth for many settings at once, in numpy over an Arrow column of images.

A setting is an overlap threshold, a range of areas and a number of predictions that count; each has a bit, so one pass over
an image's candidate pairs, a few operations on 64-bit masks each, matches for up to 62 settings. Images of a batch are taken
side by side, the k-th pair of each at a time."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Settings of one pass: bits of a long without its sign, one left over.
MOST_SETTINGS = 62
FLAGS = "array<struct<confidence:double,counted:long,hit:long>>"


def _masks(settings):
    thresholds = np.array([s[0] for s in settings])
    low, high, most = (np.array([s[k] for s in settings]) for k in (1, 2, 3))
    bit = np.uint64(1) << np.arange(len(settings), dtype=np.uint64)

    def mask(fits: np.ndarray) -> np.ndarray:
        """Rows of truth values by setting as bits."""
        return (fits * bit).sum(1, dtype=np.uint64)

    return (
        lambda iou: mask(iou[:, None] >= thresholds),
        lambda size: mask((size[:, None] >= low) & (size[:, None] <= high)),
        lambda rank: mask(rank[:, None] <= most),
    )


def flags(images: pa.Array, settings: list[tuple[float, float, float, int]]) -> pa.Array:
    """images: by rank and falling iou, structs of rank, confidence, size, and (null where nothing overlaps) iou, truth, truth_size.
    For each prediction: confidence, the settings in which it counts, and those in which it hits.

    A prediction takes the free truth of most overlap, the first of equals, one inside the range of areas before one outside. It
    counts where it takes one inside, or takes none and is inside itself."""
    if isinstance(images, pa.ChunkedArray):
        images = images.combine_chunks()
    overlaps, within, looked_at = _masks(settings)
    offsets = images.offsets.to_numpy().astype(np.int64)
    rows = pa.Table.from_struct_array(images.values.slice(offsets[0], offsets[-1] - offsets[0])) if offsets[-1] > offsets[0] else None
    if rows is None:
        return pa.array([[] for _ in range(len(images))], pa.list_(pa.struct([("confidence", pa.float64()), ("counted", pa.int64()), ("hit", pa.int64())])))
    column = lambda c, none: rows.column(c).fill_null(none).to_numpy()
    rank, confidence, size, iou, truth, truth_size = (column(c, n) for c, n in (("rank", 0), ("confidence", 0.0), ("size", 0.0), ("iou", -1.0), ("truth", 0), ("truth_size", 0.0)))
    image = np.repeat(np.arange(len(images)), np.diff(offsets))
    first = np.ones(len(rank), bool)
    first[1:] = (image[1:] != image[:-1]) | (rank[1:] != rank[:-1])
    prediction = np.cumsum(first) - 1
    heads = np.flatnonzero(first)
    inside_self, open_ = within(size[heads]), looked_at(rank[heads])
    pair = np.flatnonzero(iou >= 0)
    _, box = np.unique(np.stack([image[pair], truth[pair]], 1), axis=0, return_inverse=True)
    box = box.ravel()
    used = np.zeros(box.max(initial=-1) + 1, np.uint64)
    taken, taken_inside = np.zeros(len(heads), np.uint64), np.zeros(len(heads), np.uint64)
    able, near = overlaps(iou[pair]), within(truth_size[pair])
    # Each prediction's pairs are gone through twice: for truth inside the range, then for the rest.
    who = prediction[pair]
    order = np.lexsort((np.tile(np.arange(len(pair)), 2), np.repeat([0, 1], len(pair)), np.tile(who, 2)))
    which, outside = order % max(1, len(pair)), order >= len(pair)
    start = np.searchsorted(image[pair][which], np.arange(len(images)))
    long = np.diff(np.append(start, len(which)))
    by_length = np.argsort(-long, kind="stable")
    left = np.searchsorted(-long[by_length], -np.arange(long.max(initial=0)), "left")
    for k, n in enumerate(left):
        at = start[by_length[:n]] + k
        c, out = which[at], outside[at]
        p, t = who[c], box[c]
        new = able[c] & np.where(out, ~near[c], near[c]) & ~used[t] & ~taken[p] & open_[p]
        used[t] |= new
        taken[p] |= new
        taken_inside[p] |= np.where(out, np.uint64(0), new)
    counted = (taken_inside | (~taken & inside_self)) & open_
    out = pa.StructArray.from_arrays([pa.array(confidence[heads].astype(float)), pa.array(counted.view(np.int64)), pa.array(taken.view(np.int64))], ["confidence", "counted", "hit"])
    at = np.searchsorted(image[heads], np.arange(len(images) + 1))
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), out)


def matched(images: Column, settings: list[tuple[float, float, float, int]]) -> Column:
    """The flags of each image's predictions."""
    if len(settings) > MOST_SETTINGS:
        raise ValueError(f"more than {MOST_SETTINGS} settings in one pass")
    return F.arrow_udf(lambda x: flags(x, settings), FLAGS)(images)
