"""Suppression against a plain greedy pass, on piles and on one crowded image; running windows over cut series."""

import random
import statistics
import time
from difflib import SequenceMatcher

import pyarrow as pa
import pytest

from figloom.operators import captions, evaluation, similar, suppression

STRUCT = pa.list_(pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")]))


def share(rule, kept, box):
    more = 1 if rule == "cover" else 0
    w, h = max(min(kept[2], box[2]) - max(kept[0], box[0]) + more, 0), max(min(kept[3], box[3]) - max(kept[1], box[1]) + more, 0)
    area = lambda b: (b[2] - b[0] + more) * (b[3] - b[1] + more)
    both = area(kept) + area(box) - w * h
    return w * h / area(box) if rule == "cover" else (w * h / both if both > 0 else 0.0)


def brute(rule, most, boxes):
    kept, out = [], []
    for b in boxes:
        fine = not any(share(rule, k, b) > most if rule == "cover" else share(rule, k, b) >= most for k in kept)
        out.append(fine)
        if fine:
            kept.append(b)
    return out


def column(images):
    return pa.array([[dict(zip(("x1", "y1", "x2", "y2"), map(float, b), strict=True)) for b in im] for im in images], STRUCT)


@pytest.mark.parametrize("rule,most", [("cover", 0.4), ("iou", 0.2), ("iou", 0.7), ("cover", 0.0), ("iou", 0.0), ("iou", 1.0)])
def test_greedy_against_a_plain_pass(rule, most, monkeypatch):
    for block in (1, 4, 64):
        monkeypatch.setattr(suppression, "BLOCK", block)
        rng = random.Random(block)
        images = []
        for _ in range(40):
            reach, side = rng.choice([5, 60, 3000]), rng.choice([3, 30, 400])
            images.append([(x, y, x + rng.randint(1, side), y + rng.randint(1, side)) for x, y in ((rng.randint(-reach, reach), rng.randint(-reach, reach)) for _ in range(rng.choice([0, 1, 5, 90])))])
        got = suppression.keep(column(images), rule, most).to_pylist()
        assert got == [brute(rule, most, im) for im in images]
    assert suppression.keep(column(images).slice(3, 5), rule, most).to_pylist() == got[3:8]


def test_fifty_thousand_boxes_of_one_image():
    grid = [(x * 30, y * 30, x * 30 + 25, y * 30 + 25) for x in range(158) for y in range(158)]
    pile = [(7, 7, 30 + i % 3, 31) for i in range(25_000)]
    began = time.time()
    got = suppression.keep(column([grid + pile, pile]), "iou", 0.5).to_pylist()
    assert time.time() - began < 60
    assert sum(got[0][: len(grid)]) == len(grid) and got[0][len(grid) :].count(True) <= 1 and got[1].count(True) == 1


def naive(values, last=20):
    out, seen = [], []
    for i, _ in enumerate(values):
        recent = [v for v in values[max(0, i - last + 1) : i + 1] if v is not None]
        if values[i] is not None:
            seen.append(values[i])
        out.append((statistics.fmean(recent) if recent else None, max(recent, default=None), sorted(recent)[(len(recent) - 1) // 2] if recent else None, values[i], statistics.fmean(seen) if seen else None))
    return out


@pytest.mark.parametrize("parts", [1, 4, 60])
def test_running_values_over_cut_series(spark, parts):
    rng = random.Random(parts)
    series = {"a": 500, "b": 7, None: 90, "c": 1, "d": 41}
    rows = [(k, i, None if rng.random() < 0.1 else round(rng.random() * 50, 3)) for k, n in series.items() for i in range(n)]
    rng.shuffle(rows)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = evaluation.smooth(spark.createDataFrame(rows, "name string, step int, v double"), "name", ["step"], "v").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == len(rows)
    for k in series:
        want = naive([v for _, _, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1])])
        mine = [tuple(r)[2:] for r in sorted((r for r in got if r["name"] == k), key=lambda r: r["step"])]
        assert [tuple(None if x is None else round(x, 9) for x in r) for r in mine] == [tuple(None if x is None else round(x, 9) for x in r) for r in want]


def ratio_brute(rows, most):
    gone = set()
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[1] < b[1] and SequenceMatcher(None, a[2], b[2]).ratio() >= most:
                gone.add(a[:2] if len(a[2]) < len(b[2]) else b[:2])
    return gone


@pytest.mark.parametrize("most,block", [(0.7, 3), (0.2, 2), (0.86, 512), (1.0, 1)])
def test_similar_texts_over_blocks(spark, monkeypatch, most, block):
    monkeypatch.setattr(similar, "BLOCK", block)
    rng = random.Random(block)
    words = ["gold", "iron", "film", "rods", "on", "a", "grid", "é", "😀"]
    rows = [(g, i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for g in range(4) for i in range(14)]
    df = spark.createDataFrame([*rows, (9, 0, None), (9, 1, None)], "g long, seq int, t string")
    got = {tuple(r) for r in captions.prune_similar(df, "g", "seq", "t", most).select("g", "seq").collect()}
    assert got == {r[:2] for r in rows} - ratio_brute(rows, most) | {(9, 0), (9, 1)}


def test_a_group_of_ten_thousand_texts(spark):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    strangers = ["".join(rng.choices(letters[7 * (k % 8) : 7 * (k % 8) + 9], k=10 + k // 8 * 11)) for k in range(40)]
    near = [f"a TEM image of gold rods on a carbon film, number {i}" for i in range(10_000)]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(near + strangers)], "g long, seq int, t string")
    began = time.time()
    left = captions.prune_similar(df, "g", "seq", "t", 0.9)
    stays = {r["seq"] for r in left.collect()}
    assert time.time() - began < 120
    assert len([s for s in stays if s < 10_000]) == 1 and stays >= {10_000 + k for k in range(40) if k % 8 == 0}


@pytest.mark.parametrize("most", [0.0, 0.5, 0.7, 0.86, 1.0])
def test_groups_of_a_batch_are_compared_together(most):
    """The same as pair by pair with difflib: empty, unknown, equal, long texts, any order."""
    rng = random.Random(int(most * 100))
    rows = []
    for _ in range(60):
        letters, longest = rng.choice(["ab", "abc d", "abcdefghij é😀"]), rng.choice([3, 12, 60, 260])
        texts = [(rng.randint(0, 30), rng.choice([None, *["".join(rng.choices(letters, k=rng.randint(0, longest)))] * 9])) for _ in range(rng.randint(0, 9))]
        texts += [(40, t) for _, t in texts[:2]]
        rows += [(texts, None), (texts[:3], texts[3:])]

    def plain(before, text):
        known = [(o, t) for o, t in before if t is not None and text[1] is not None]
        return any(SequenceMatcher(None, *((t, text[1]) if o < text[0] else (text[1], t))).ratio() >= most for o, t in known)

    want = [[plain(a[:i] if b is None else a, x) for i, x in enumerate(a if b is None else b)] for a, b in rows]
    assert similar._matched(rows, most) == want
    assert similar._matched([], most) == [] and similar._matched([([], None)], most) == [[]]
