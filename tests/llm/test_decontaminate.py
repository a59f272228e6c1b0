import random
import re

import numpy as np

from figloom.llm import decontaminate as dc


def terms(t):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        now = [i]
        for j, t in enumerate(text, 1):
            now.append(min(row[j - 1] + (p != t), row[j] + 1, now[j - 1] + 1))
        row = now
    return min(row)


def brute(docs, items, most=0.2):
    out = {}
    for d, t in docs:
        for k, x in items:
            p = terms(x)
            if p and terms(t) and (e := distance(p, terms(t))) <= (int(most * len(p)) if len(p) >= dc.LEAST_TERMS else 0):
                out[(d, k)] = e
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)] + ["the"] * 60 + ["of"] * 40
    items = [(i, " ".join(rng.choices(words, k=rng.randint(9, 60)))) for i in range(30)] + [(90, "three short words"), (91, None), (92, " ,. "), (93, "One")]
    docs = []
    for i in range(240):
        text = rng.choices(words, k=rng.randint(0, 150))
        if i % 2:
            p = list(terms(items[rng.randrange(30)][1]))
            for _ in range(rng.randint(0, int(0.2 * len(p)))):
                k = rng.randrange(len(p))
                p[k : k + 1] = rng.choice([[], ["new"], [p[k], "more"]])
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() + "," for w in p] if i % 3 else p
        docs.append((i, " ".join(text)))
    docs += [(500, None), (501, ""), (502, items[0][1]), (503, "x " * 30_000 + items[1][1]), (504, "Three, SHORT words!"), (502, items[0][1])]
    found = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in found.collect()}
    want = brute([d for d in docs if d[0] != 503], items) | {(503, 1): 0}
    assert found.count() == len(got) and set(got) <= set(want) and all(got[k] >= want[k] for k in got)
    assert {k for k, e in want.items() if e == 0} <= set(got)
    assert len(got) >= 0.9 * len(want), (len(got), len(want))
    blocks = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_items=9)
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == set(got)


def test_empty(spark):
    docs, items = (spark.createDataFrame([], f"{k} long, text string") for k in ("doc_id", "item_id"))
    assert dc.leaks(docs, items).count() == 0
    assert dc.leaks(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), items).count() == 0


def test_walk_emits_the_window_of_equal_terms():
    a = np.random.default_rng(1).integers(1, 1 << 62, 100, np.uint64)
    b = np.concatenate([a[40:90], a[:3]])
    assert (dc.walk(a, np.array([40]), 80)[:60] == dc.walk(b, np.array([0]), 80)[:60]).all()


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        k = rng.randrange(len(out))
        out[k : k + 1] = rng.choice([[], [f"new{rng.getrandbits(40)}"], [out[k], f"more{rng.getrandbits(40)}"]])
    return out


def recall(length, share, trials=100, seed=5):
    """Share of items of one length that are found among other terms after edits, each alone in its index and text."""
    rng, hits = random.Random(seed), 0
    for i in range(trials):
        item = [f"i{i}x{j}" for j in range(length)]
        text = [f"a{j}" for j in range(rng.randrange(40))] + edited(rng, item, int(share * length)) + [f"b{j}" for j in range(40)]
        raw = np.frombuffer(" ".join(text).encode(), np.uint8)
        hits += bool(dc.search(*dc.terms_of(raw, np.array([0, len(raw)])), dc.build_index([(0, " ".join(item))], 0.2, 0.985, 0.75)))
    return hits / trials


def test_short_items_are_found():
    for length in (8, 9, 10, 12, 15):
        assert recall(length, 0) == recall(length, 0.2) == 1, length


def test_items_of_few_different_terms_are_found():
    for item in ("ha " * 9, "no no yes " * 4, "la li lu " * 20):
        index = dc.build_index([(0, item)], 0.2, 0.985, 0.75)
        raw = np.frombuffer(f"one two three four five {item} six".encode(), np.uint8)
        assert dc.search(*dc.terms_of(raw, np.array([0, len(raw)])), index) == {(0, 0): (0, 5)}


def test_all_lengths_are_found_at_the_most_edits():
    for length in (16, 20, 30, 59, 90, 150):
        assert recall(length, 0.2, trials=40) == 1, length


def test_edits_are_those_of_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([8, 10, 15, 25, 80])))) for i in range(15)]
    docs = []
    for i in range(150):
        p = terms(items[i % 15][1])
        docs.append((i, " ".join(rng.choices(words, k=rng.randrange(60)) + edited(rng, p, rng.randrange(int(0.2 * len(p)) + 2)) + rng.choices(words, k=rng.randrange(60)))))
    found = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in found.collect()} == brute(docs, items)
