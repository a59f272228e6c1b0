"""Joins by grid cells against all pairs, on few boxes in every position and on one crowded figure."""

import random

import pytest

from figloom.operators import geometry, scale

BOX = "figure_id long, idx int, x1 int, y1 int, x2 int, y2 int"


def boxes(rng, n, reach, most):
    out = []
    for i in range(n):
        x, y = rng.randint(-reach, reach), rng.randint(-reach, reach)
        out.append((rng.randint(1, 2), i, x, y, x + rng.randint(0, most), y + rng.randint(0, most)))
    return out


def iou(a, b):
    w, h = min(a[4], b[4]) - max(a[2], b[2]), min(a[5], b[5]) - max(a[3], b[3])
    both = w * h if w > 0 and h > 0 else 0
    union = (a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - both
    return both / union if both else 0


@pytest.mark.parametrize("seed,side,pad", [(1, 7, 0), (2, 64, 5), (3, 1000, 0), (4, 50, -3)])
def test_pairs_are_those_of_all_pairs(spark, seed, side, pad):
    rng = random.Random(seed)
    a, b = boxes(rng, 70, 150, 90), boxes(rng, 70, 150, 30)
    da, db = spark.createDataFrame([*a, (1, 999, None, 0, 5, 5)], BOX), spark.createDataFrame(b, BOX)
    inside = sorted((i[0], i[1], o[1]) for i in b for o in a if i[0] == o[0] and i[2] > o[2] - pad and i[3] > o[3] - pad and i[4] < o[4] + pad and i[5] < o[5] + pad)
    got = geometry.contained(db, da, "figure_id", pad, side)
    assert sorted((r["figure_id"], r["in_idx"], r["out_idx"]) for r in got.collect()) == inside
    pairs = {(x[0], x[1], y[1]): iou(x, y) for x in a for y in a if x[0] == y[0] and x[1] < y[1] and iou(x, y) > 0}
    got = geometry.iou_pairs(da, "figure_id", "idx", side).collect()
    assert {(r["figure_id"], r["a_idx"], r["b_idx"]): pytest.approx(r["iou"]) for r in got} == pairs and len(got) == len(pairs)


def test_nearest_are_those_of_all_pairs(spark):
    rng = random.Random(9)
    lines, labels = boxes(rng, 120, 300, 40), boxes(rng, 90, 300, 40)
    want = {}
    for a in lines:
        far = [(((a[2] + a[4] - b[2] - b[4]) / 2) ** 2 + ((a[3] + a[5] - b[3] - b[5]) / 2) ** 2, b[1]) for b in labels if b[0] == a[0]]
        d, k = min(far)
        want[a[1]] = (k, d) if d <= scale.NEAR else (None, -1.0)
    got = scale.nearest_label(spark.createDataFrame(lines, BOX), spark.createDataFrame(labels, BOX), "figure_id").collect()
    assert {r["line_idx"]: (r["label_idx"], r["distance"]) for r in got} == want and len(got) == len(lines)


def test_one_figure_of_two_hundred_thousand_boxes(spark):
    n = 200_000
    b = spark.range(n).selectExpr("1L as figure_id", "cast(id as int) as idx", "cast(id % 450 * 40 as int) as x1", "cast(id div 450 * 40 as int) as y1").selectExpr("*", "x1 + 45 as x2", "y1 + 30 as y2")
    assert geometry.iou_pairs(b, "figure_id", "idx").count() == n - -(-n // 450)  # each with the next of its row
    inner = b.selectExpr("figure_id", "idx", "x1 + 46 - 40 as x1", "y1 + 1 as y1", "x1 + 39 as x2", "y1 + 20 as y2")
    assert geometry.contained(inner, b, "figure_id").count() == n
    found = scale.nearest_label(b, inner, "figure_id")
    assert found.where("label_idx = line_idx").count() == n
    plan = geometry.contained(inner, b, "figure_id")._jdf.queryExecution().toString()
    assert "gx" in plan and "NestedLoop" not in plan
