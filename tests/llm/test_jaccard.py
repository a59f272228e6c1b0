import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from figloom.llm import jaccard
from figloom.llm.components import components


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    sets = {d: shingles(t, n) for d, t in rows}
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def texts(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n // 8):
        base = rng.choices(vocabulary, k=rng.choice([3, 9, 20, 60, 150, 400]))
        for k in range(8):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words).upper() if k == 5 else " ".join(words))
    return list(enumerate(out))


@pytest.mark.parametrize("n,percent,broadcast_ids,small", [(3, 90, 4, 8), (5, 80, 4, 2), (3, 60, 0, 8)])
def test_matches_brute_force(spark, monkeypatch, n, percent, broadcast_ids, small):
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", small)
    rows = texts(n + percent) + [(900, None), (901, ""), (902, "one two"), (903, "One  two"), (904, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as node")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(docs, n, percent, broadcast_ids).collect()}
    assert got == brute(rows, n, percent)


def test_one_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", 4)
    rng = random.Random(9)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randint(1, 9)):
            k = rng.randrange(len(words))
            words[k : k + 1] = rng.choice([[], [f"w{rng.randrange(900)}"], [words[k], "more"]])
        rows.append((i, " ".join(words)))
    for n, percent in ((3, 90),):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()}
        assert got == brute(rows, n, percent)


def test_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "z y x w v u"), (2, "z y x w v u"), (None, "a b c d e f"), (None, None)]
    found = jaccard.link(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    assert found.count() == 6 and {r["component_id"] for r in found.where("n_shingles > 0").collect()} == {1}
    assert jaccard.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_linked_pair_shares_a_signature():
    rng = np.random.default_rng(5)
    for percent in (60, 80, 90):
        bands = jaccard.Bands(percent)
        shapes = set()
        for size in (1, 2, 5, 9, 10, 11, 19, 40, 99, 300, 1200, 3500):
            shapes.add(bands.shape[int(bands.of(np.array([size]))[0])])
            for _ in range(8):
                a = rng.integers(0, 1 << 63, size, np.uint64)
                d = rng.integers(0, max(1, size * (100 - percent) // 100) + 1)
                b = np.concatenate([a[d:], rng.integers(0, 1 << 63, rng.integers(0, d + 1), np.uint64)])
                i = len(np.intersect1d(a, b))
                if not i or 100 * i < percent * (len(a) + len(b) - i):
                    continue
                sigs = [{int(x) for sig, _ in jaccard.signatures(np.sort(s), np.array([0, len(s)]), bands) for x in sig} for s in (a, b)]
                assert sigs[0] & sigs[1], (percent, size)
        assert percent != 80 or len(shapes) > 1  # parts as such, and subsets of their sub-parts


@pytest.mark.parametrize("size,most", [(150, 0.35), (300, 0.5), (1000, 0.5)])
def test_strangers_seldom_share_a_signature(size, most):
    """Sets that have a tenth of their shingles in common (of those that have more, most meet)."""
    rng = np.random.default_rng(size)
    bands, met = jaccard.Bands(80), 0
    for _ in range(60):
        common, own = rng.integers(0, 1 << 63, size // 10, np.uint64), size - size // 10
        sigs = [{int(x) for sig, _ in jaccard.signatures(np.sort(np.concatenate([common, rng.integers(0, 1 << 63, own, np.uint64)])), np.array([0, size]), bands) for x in sig} for _ in range(2)]
        met += bool(sigs[0] & sigs[1])
    assert met / 60 <= most


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 30), (40, 40), (None, 3), (60, 50), (70, 60), (80, 50)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 21)}, 31: 30, 60: 50, 70: 50, 80: 50}


def test_signatures_counted_in_turns(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TURN", 20)
    kept = []
    monkeypatch.setattr(jaccard, "_recurring", lambda *a, f=jaccard._recurring: kept.append(a[2:]) or f(*a))
    rows = texts(11)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 5, 80) and kept == [(k, jaccard.TURNS) for k in range(jaccard.TURNS)]


def test_tables_read_for_the_last_time_go(spark, monkeypatch):
    """Members and the differences from the hubs aren't kept on disk while the next buckets are made."""
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", 2)
    stored, seen = [], []

    def materialise(df, f=jaccard.materialise):
        out = f(df)
        stored.append((tuple(out.columns), out.stored_at))
        return out

    def next_buckets(*a, f=jaccard._next_buckets):
        gone = {("sig", "node", "n"), ("u", "v", "n_u", "n_v", "links", "d")}
        seen.extend(os.path.exists(path.removeprefix("file:")) for columns, path in stored if columns in gone)
        return f(*a)

    monkeypatch.setattr(jaccard, "materialise", materialise)
    monkeypatch.setattr(jaccard, "_next_buckets", next_buckets)
    rng = random.Random(3)
    shared = [f"s{i}" for i in range(160)]
    rows = [(i, " ".join(shared + [f"w{rng.randrange(9000)}" for _ in range(30 + i % 12)])) for i in range(80)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 5, 80)
    assert seen and not any(seen)


def test_strangers_of_one_hub_are_told_apart_by_bitmaps(spark, monkeypatch):
    """No differences of whole sets are made of strangers who share many buckets; the links among them are found."""

    def never(*a):
        raise AssertionError("strangers reached the next buckets")

    monkeypatch.setattr(jaccard, "_next_buckets", never)
    rng = random.Random(3)
    shared = [f"s{i}" for i in range(160)]
    rows = [(i, " ".join(shared + [f"w{rng.randrange(9000)}" for _ in range(30 + i % 12)])) for i in range(80)]
    rows += [(100 + i, text + " more" * (i % 3)) for i, text in rows[5:80:9]]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 5, 80) and len({c for _, c in got.values()}) == 80


@pytest.mark.parametrize("small", [1, 2, 3])
def test_two_families_and_strangers_of_one_hub(spark, monkeypatch, small):
    """Hubs of too many classes, and those of which too many pairs are left, go on to the differences: no link is lost."""
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", small)
    rng = random.Random(small)
    shared = [f"s{i}" for i in range(110)]
    rows = []
    for family in range(3):
        own = [f"f{family}_{i}" for i in range(55)]
        rows += [(len(rows) + i, " ".join(shared + own[: 50 + i % 6] + [f"w{rng.randrange(9000)}" for _ in range(rng.randint(0, 30))])) for i in range(14)]
    rows += [(100 + i, " ".join(shared + [f"w{rng.randrange(9000)}" for _ in range(60)])) for i in range(25)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 5, 80)


def test_a_turns_signatures_go_before_the_next_is_counted(spark, monkeypatch):
    """The disk holds the signatures that are still to be counted, SIG bytes each; pairs are intersected in turns."""
    monkeypatch.setattr(jaccard, "TURN", 20)
    monkeypatch.setattr(jaccard, "ELEMENTS", 1)
    seen = []

    def recurring(whole, *a, f=jaccard._recurring):
        here = [x for x in os.listdir(whole.stored_at.removeprefix("file:")) if x.startswith("turn=")]
        seen.append((a[1], sorted(here), {r[0] % jaccard.SIG for r in whole.where(F.col("turn") == a[1]).select(F.octet_length("sigs")).collect()}))
        return f(whole, *a)

    monkeypatch.setattr(jaccard, "_recurring", recurring)
    rows = texts(11)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 5, 80)
    assert seen == [(k, [f"turn={j}" for j in range(k, jaccard.TURNS)], {0}) for k in range(jaccard.TURNS)]
