"""Queries and operators that have no twin, held against plain Python."""

import random
import re
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from figloom.operators import captions, detections, evaluation, geometry, labels, pages
from figloom.plans.registry import QUERIES

D = "/root/testdata/sf0.001"
G = "figure_id"
BOX = "figure_id long, idx int, x1 int, y1 int, x2 int, y2 int, confidence double"


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    i = w * h
    return i / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i)


def report(truth, found):
    """The detection report, one image, threshold and prediction after the other."""

    def size(b):
        return (b[2] - b[0]) * (b[3] - b[1])

    def one(threshold, area, most):
        lo, hi = evaluation.AREAS[area]
        flags, total = [], 0
        for g in {t[0] for t in truth} | {p[0] for p in found}:
            ts = [t[1:] for t in truth if t[0] == g]
            total += sum(lo <= size(t[1:5]) <= hi for t in ts)
            used = set()
            for p in sorted((p for p in found if p[0] == g), key=lambda p: (-p[6], p[1]))[:most]:
                fits = [(not lo <= size(t[1:5]) <= hi, -iou(p[2:6], t[1:5]), t[0]) for t in ts if iou(p[2:6], t[1:5]) >= threshold and t[0] not in used]
                best = min(fits, default=None)
                if best:
                    used.add(best[2])
                if not best[0] if best else lo <= size(p[2:6]) <= hi:
                    flags.append((p[6], best is not None))
        if not total:
            return None
        points = []
        for c in {c for c, _ in flags}:
            tp, n = sum(h for x, h in flags if x >= c), sum(x >= c for x, _ in flags)
            points.append((tp / total, tp / n))
        ap = sum(max((p for r, p in points if r * 100 + 1e-9 >= k), default=0.0) for k in range(101)) / 101
        return ap, max((r for r, _ in points), default=0.0)

    steps = [0.5 + 0.05 * k for k in range(10)]
    mean = lambda area, most, k: (lambda x: None if None in x else sum(v[k] for v in x) / 10)([one(t, area, most) for t in steps])
    out = {"AP": mean("all", 100, 0), "AP50": one(0.5, "all", 100)[0], "AP75": one(0.75, "all", 100)[0]}
    for a in ("small", "medium", "large"):
        out |= {f"AP_{a}": mean(a, 100, 0), f"AR_{a}": mean(a, 100, 1)}
    return out | {f"AR{k}": mean("all", k, 1) for k in (1, 10, 100)}


@pytest.mark.parametrize("seed", [1, 2])
def test_detection_report(spark, seed):
    rng = random.Random(seed)
    truth, found = [], []
    for g in range(12):
        for i in range(rng.randint(0, 14)):
            x, y, w, h = rng.randrange(200), rng.randrange(200), rng.choice([8, 20, 40, 120]), rng.choice([9, 25, 60])
            truth.append((g, i, x, y, x + w, y + h, 1.0))
            for k in range(rng.randint(0, 2)):
                found.append((g, 10 * i + k, x + rng.randint(0, 3), y, x + w + rng.randint(0, 9), y + h, round(rng.random(), 2)))
        found.append((g, 900, 500, 500, 500 + rng.choice([9, 50, 300]), 520, round(rng.random(), 2)))
    if seed == 2:
        truth = [t for t in truth if t[4] - t[2] < 100]
    got = {r["metric"]: r["value"] for r in evaluation.detection_summary(spark.createDataFrame(truth, BOX), spark.createDataFrame(found, BOX), G).collect()}
    want = report(truth, found)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == (v if v is None else pytest.approx(v)), k


def test_report_query_tells_before_and_after(spark):
    got = {r["metric"]: (r["before"], r["after"]) for r in QUERIES["i9_detection_summary"](spark, D).collect()}
    assert len(got) == 12 and all(0 <= x <= 1 for v in got.values() for x in v if x is not None)


def test_matches_of_points(spark):
    rng = random.Random(3)
    t = [(g, i, rng.randrange(60), rng.randrange(60)) for g in range(9) for i in range(rng.randint(1, 6))]
    p = [(g, i, rng.randrange(60), rng.randrange(60)) for g in range(8) for i in range(rng.randint(0, 6))]
    want = {}
    for g in {x[0] for x in t}:
        used = set()
        mine = [x for x in p if x[0] == g]
        for _, _, x, y in sorted(a for a in t if a[0] == g):
            near = min((((x - b[2]) ** 2 + (y - b[3]) ** 2, b[1]) for b in mine if b[1] not in used), default=(1e9, 0))
            if near[0] <= 300:
                used.add(near[1])
        n = sum(a[0] == g for a in t)
        want[g] = (len(used), n - len(used), len(mine) - len(used))
    schema = "figure_id long, idx int, cx double, cy double"
    found = evaluation.match_truth(*(spark.createDataFrame([(g, i, float(x), float(y)) for g, i, x, y in rows], schema) for rows in (t, p)), G, near=300.0)
    assert {r[G]: tuple(r)[1:] for r in found.collect()} == want


def test_similar_texts_against_plain_python(spark):
    rng = random.Random(5)
    rows = []
    for g in range(6):
        base = [rng.choice(["gold", "iron", "film", "rods", "on", "a", "grid"]) for _ in range(7)]
        for i in range(5):
            rows.append((g, i, " ".join(rng.choice(["x", "y"]) if rng.random() < 0.25 else w for w in base)))
    rows.append((6, 0, ""))
    gone = set()
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[1] < b[1] and SequenceMatcher(None, a[2], b[2]).ratio() >= 0.7:
                gone.add(a[:2] if len(a[2]) < len(b[2]) else b[:2])
    got = {tuple(r) for r in captions.prune_similar(spark.createDataFrame(rows, "g long, seq int, t string"), "g", "seq", "t", 0.7).select("g", "seq").collect()}
    assert got == {r[:2] for r in rows} - gone


@pytest.mark.parametrize("text,want", [
    ("x (a) y", [("alpha", "(a)")]), ("a) x b) y", [("alpha", "a)"), ("alpha", "b)")]), ("a: x", [("alpha", "a:")]), ("(a x", [("alpha", "(a")]), ("see :B: x", [("ALPHA", ":B:")]),
    ("(a1) x (B2) y", [("alpha", "(a1)"), ("ALPHA", "(B2)")]), ("End. a, b so", [("alpha", ". a, b")]), ("(Upper left) x", [("position", "(Upper"), ("position", "left)")]), ("(iv) x", [("roman", "(iv)")]), ("nab) x", []),
    ("(i) x", [("alpha", "(i)"), ("roman", "(i)")]), ("(xlix) (l) (li)", [("alpha", "(l)"), ("roman", "(xlix)"), ("roman", "(l)")]), ("(next to) (upside  down)", [("position", "(next to)"), ("position", "down)")]),
    ("(2, 3 and 4) of (10)", [("digit", "(2, 3 and 4)")]), ("(A AND B) x", [("ALPHA", "(A AND B)")]), ("(a, bc) (d-", [("alpha", "(a"), ("alpha", "(d")]), ("(µ) (é:", []),
])
def test_label_forms(spark, text, want):
    got = captions.label_spans(spark.createDataFrame([(1, text)], "k long, caption string"), "k")
    assert sorted((r["kind"], r["span"]) for r in got.collect()) == sorted(want)


def label_patterns():
    def forms(c, more=""):
        r = rf"{c}(?:(?:\s*(?:,|–|-|(?i:and)|,\s*(?i:and))\s*){c})*"
        return re.compile(rf"(?:\({r}\)|{more}:{r}:|\({r}|:{r}|{r}[):])", re.ASCII)

    return {
        "alpha": forms(r"\b[a-z]\b", r"\([a-z][0-9]\)|\. [a-z]\b(?:(?:,|–) ?[a-z]\b)?|"), "ALPHA": forms(r"\b[A-Z]\b", r"\([A-Z][0-9]\)|"), "digit": forms(r"\b[0-9]\b"),
        "roman": forms(rf"\b(?i:{'|'.join(labels.ROMAN)})\b"), "position": forms(rf"\b(?i:{'|'.join(labels.POSITIONS)})\b"),
    }


@pytest.mark.parametrize("seed", range(3))
def test_automaton_against_patterns(seed):
    rng = random.Random(seed)
    pieces = ["(", ")", ":", ".", ",", "-", "–", " ", " ", "  ", "a", "b", "z", "A", "C", "1", "7", "a1", "B2", "iv", "II", "i", "upper", "next to", "in", "and", "AND", "gold", "shown in (a)", "x.", "\n", "(b)", "(c, d)"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(1500)] + [None, "", "(" * 50, "(a" + ", b" * 30_000 + ")"]
    patterns = label_patterns()
    for text, got in zip(texts, labels.parse(pa.array(texts)).to_pylist(), strict=True):
        want = [(k, m.group(), m.start() + 1) for k, p in patterns.items() for m in p.finditer(text or "")]
        assert [(s["kind"], s["span"], s["pos"]) for s in got] == want, text


def test_captions_are_cut_at_their_own_kind(spark):
    caps = [
        (1, "(A) gold rods. (B) iron films."), (2, "Map. (1) one, shown in (2) too; (2) two"), (3, "(ii) two (iii–iv) more (vi) six"), (4, "(left) tip (next to) base"), (5, "Gold (a) and iron (b, c)."),
        (6, "no labels"), (7, None), (8, "(a) x (B) y (c) z"), (9, "é (a) ü 😀 (b) ß"),
    ]
    df = spark.createDataFrame(caps, "k long, caption string")
    got = {}
    for r in captions.segments(df, "k").orderBy("k", "seq").collect():
        got.setdefault(r["k"], []).append((r["kind"], r["span"], r["segment"]))
    assert got == {
        1: [("ALPHA", "(A)", "gold rods."), ("ALPHA", "(B)", "iron films.")], 2: [("digit", "(1)", "one, shown in (2) too;"), ("digit", "(2)", "two")], 3: [("roman", "(ii)", "two"), ("roman", "(iii–iv)", "more"), ("roman", "(vi)", "six")],
        4: [("position", "(left)", "tip"), ("position", "(next to)", "base")], 5: [("alpha", "(a)", "Gold"), ("alpha", "(b, c)", "and iron")],
        8: [("alpha", "(a)", "x (B) y"), ("alpha", "(c)", "z")], 9: [("alpha", "(a)", "ü 😀"), ("alpha", "(b)", "ß")],
    }
    told = captions.segments(df.withColumn("d", F.when(F.col("k") == 8, "ALPHA").otherwise("alpha")), "k", delimiter="d")
    assert {(r["k"], r["span"]) for r in told.collect()} == {(8, "(B)"), (5, "(a)"), (5, "(b, c)"), (9, "(a)"), (9, "(b)")}
    assert {r["k"]: r["p"] for r in df.select("k", captions.preamble(F.col("caption")).alias("p")).collect()}[2] == "Map."


@pytest.mark.parametrize("span,kind,want", [
    ("(i-v)", "roman", ["i", "ii", "iii", "iv", "v"]), ("(i-v)", "alpha", list("ijklmnopqrstuv")), ("(I–III)", "roman", ["I", "II", "III"]), ("(xlviii-l)", "roman", ["l", "xlix", "xlviii"]), ("(A-C and E)", "ALPHA", ["A", "B", "C", "E"]),
    ("(2-4)", "digit", ["2", "3", "4"]), ("(Left and next to)", "position", ["Left", "next to"]), ("(c-a)", "alpha", ["a", "c"]),
])
def test_ranges_by_kind(spark, span, kind, want):
    assert spark.range(1).select(captions.implied_labels(F.lit(span), F.lit(kind)).alias("l")).first()["l"] == want


def test_elements_are_labels_where_capitals_delimit(spark):
    caps = spark.createDataFrame([(1, "(A) x (B) y (C) z"), (2, "(a) x of (C) y (b) z (In) (c")], "k long, caption string")
    s = captions.label_spans(caps, "k").where("kind in ('alpha', 'ALPHA', 'position')")
    told = captions.drop_chemistry(s.join(captions.delimiter(s, "k"), "k"))
    assert sorted((r["k"], r["span"]) for r in told.collect()) == [(1, "(A)"), (1, "(B)"), (1, "(C)"), (2, "(a)"), (2, "(b)")]


@pytest.mark.parametrize("text,want", [
    ("images of a; b .; c; d", "images of a, b ., c; d"), ("x; images of a; b", "x; images of a, b"), ("map; a; b", "map; a; b"), ("z; a; z", "z, a; z"), ("images of a. b. c; d", "images of a. b. c; d"),
])
def test_semicolons(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(captions.repair_semicolons(F.col("t"), "images of", " .")).first()[0] == want


def test_crops_of_several_boxes(spark):
    images = spark.createDataFrame([(1, 4, 3, 1, bytearray(range(12))), (2, 2, 2, 2, bytearray(range(8)))], "figure_id long, width int, height int, channels int, data binary")
    b = spark.createDataFrame([(1, 0, 1, 1, 3, 3), (1, 1, 0, 0, 9, 1), (2, 0, -1, 0, 1, 2)], "figure_id long, idx int, x1 int, y1 int, x2 int, y2 int")
    got = {(r[G], r["idx"]): (r["width"], r["height"], bytes(r["data"])) for r in geometry.crop(images, b).collect()}
    assert got == {(1, 0): (2, 2, bytes([5, 6, 9, 10])), (1, 1): (4, 1, bytes([0, 1, 2, 3])), (2, 0): (1, 2, bytes([0, 1, 4, 5]))}


def test_scores_come_from_the_given_model(spark):
    images = spark.createDataFrame([(i, bytearray([i, 2 * i])) for i in range(5)], "figure_id long, data binary")

    def load():
        return lambda pdf: pd.DataFrame({"figure_id": pdf["figure_id"], "total": [float(sum(x)) for x in pdf["data"]]})

    got = {r[G]: r["total"] for r in detections.score(images, load, "figure_id long, total double").collect()}
    assert got == {i: 3.0 * i for i in range(5)}


def test_sample_is_the_least_of_a_hash(spark):
    figures = spark.range(500).withColumnRenamed("id", G)
    order = [r[G] for r in figures.orderBy(F.xxhash64(F.col(G).cast("string"), F.lit(7)), G).collect()]
    assert sorted(r[G] for r in evaluation.sample_figures(figures, G, 25, 7).collect()) == sorted(order[:25])
    assert evaluation.sample_figures(figures, G, 25, 8).join(evaluation.sample_figures(figures, G, 25, 7), G, "left_anti").count() > 0


def test_open_badge_within_three_ancestors(spark):
    html = '<ul><li><div><h3><a href="/a?page=search">x<br></a></h3><span class="text-orange">Open</span></div></li><li><div><h3><a href="/b">y</a></h3></div><span class="text-orange">Open</span></li><li><p><b><a href="/c">z</a></b></p><span class="text-orange">Closed</span></li></ul>'
    got = pages.open_links(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string"))
    assert sorted(r["link"] for r in got.collect()) == ["/a", "/b"]


def test_images_stay_where_they_are_while_boxes_are_cut(spark):
    """Pixels of images dealt by figure_id are neither shuffled, sorted nor broadcast; unknown corners and pixels give none."""
    images = spark.createDataFrame([(1, 4, 3, 1, bytearray(range(200, 212))), (2, 2, 2, 1, None)], "figure_id long, width int, height int, channels int, data binary")
    b = spark.createDataFrame([(1, 0, 1, 1, 3, 3), (1, 1, None, 0, 1, 1), (2, 0, 0, 0, 1, 2), (1, 2, 3, 2, 1, 1)] + [(1, i, 0, 0, 1, 1) for i in range(3, 40)], "figure_id long, idx int, x1 int, y1 int, x2 int, y2 int")
    out = geometry.crop(images.repartition(4, G), b)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan and "Python" not in plan and "MapInPandas" not in plan
    got = {(r[G], r["idx"]): r["data"] if r["data"] is None else bytes(r["data"]) for r in out.collect()}
    assert got == {(1, 0): bytes([205, 206, 209, 210]), (1, 1): None, (2, 0): None, (1, 2): b""} | {(1, i): bytes([200]) for i in range(3, 40)}
    with pytest.raises(Exception, match="another size"):
        geometry.crop(images.withColumn("height", F.lit(9)).where("figure_id = 1"), b).collect()


def test_shared_text_is_told_from_one_row_a_caption(spark):
    rows = [(1, 0, "gold rods", "x"), (1, 1, "rods", "y"), (1, 2, "", "z"), (1, 3, None, "n"), (1, None, "rods and rods", "o"), (1, 4, "rods", "y"), (2, 0, "rods", "k"), (None, 0, "a b", "k"), (None, 1, "b", "k")]
    segs = spark.createDataFrame(rows, "figure_id long, seq int, segment string, span string")
    out = captions.drop_shared_text(segs, G)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    left = [r for r in rows if r[:3] not in {(1, 0, "gold rods"), (1, 1, "rods"), (1, 4, "rods")}]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(left, key=key)
