"""License scans: the automaton against plain search, phrases against all places, templates found through edits."""

import random
import re

import numpy as np
import pytest

from figloom.llm import licenses


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_matching_statistics_against_plain_search():
    rng = random.Random(4)
    for _ in range(60):
        told = [[rng.randrange(3) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 5))]
        a = licenses.Automaton(told, 3)
        known = {c for t in told for c in t}
        runs = [[rng.choice(sorted(known)) for _ in range(rng.randint(1, 12))] for _ in range(4)]
        codes = np.array([c for r in runs for c in r])
        stops = np.cumsum([len(r) for r in runs])
        states, lengths = a.statistics(codes, stops - [len(r) for r in runs], stops)
        at = 0
        for r in runs:
            for j in range(len(r)):
                tail = [r[i : j + 1] for i in range(j + 1)]
                places = lambda s: {(k, e) for k, t in enumerate(told) for e in range(len(t)) if e + 1 >= len(s) and t[e + 1 - len(s) : e + 1] == s}  # noqa: B023, E731
                longest = next(s for s in tail if places(s))
                assert lengths[at] == len(longest)
                assert {tuple(x) for x in a.ends[states[at]].tolist()} == places(longest)
                at += 1


def brute_base(text):
    w = words(text)
    hits = [(i, label) for label, p in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))


APACHE = licenses.TEMPLATES[2][1]
TEXTS = [
    None, "", " \n ", "mit license", "the MIT\tLicense, MIT-license; mit x license. GENERAL public License", "mit", "license mit", "apache license apache", "Mit éLicense mit licensé mit license9",
    "MIT LICENSE " * 3000, "mit " * 5000 + "license", "x" * 100_000, APACHE, "word " * 50 + APACHE.upper() + " word" * 50, "Licensed under CC BY-NC 4.0 here",
]


def test_base_columns_against_all_places(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS), (3, TEXTS[3]), (None, "mit license")], "doc_id long, text string").selectExpr("*", "1 as n_words", "'a' as labels")
    got = licenses.scan(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "mit license" if r["doc_id"] is None else TEXTS[r["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
        assert r["score"] == 1 or not r["n_base"]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_phrases_within_phrases(spark):
    docs = spark.createDataFrame([(1, "a b c a b b c c"), (2, "b c")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in licenses.scan(docs, [("x", "a b c"), ("y", "b c"), ("z", "c")], []).collect()}
    assert got == {1: (6, 0, 7, "x,y,z"), 2: (2, 0, 1, "y,z")}


@pytest.mark.parametrize("seed", range(3))
def test_templates_are_found_through_edits(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for k, (label, text) in enumerate(licenses.TEMPLATES):
        w = words(text)
        if len(w) < 30:
            continue
        for at in range(25, len(w), 25):  # a word in 25 replaced, some dropped
            w[at] = rng.choice(["zzz", "yyy zzz", ""])
        before = rng.randint(0, 40)
        rows.append((k, " ".join(["noise"] * before + [x for x in w if x] + ["noise"] * 9)))
        want[k] = (label, before)
    rows += [(1000, "permission is hereby granted to any person"), (1001, "the license of this software is subject to the terms of the sea")]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (label, before) in want.items():
        assert label in got[k]["labels"].split(",")
        span = next(s for s in got[k]["spans"] if s["template"] == k)
        assert span["first_word"] == before and span["coverage"] > 0.6 and span["first_word"] + span["n_words"] <= got[k]["n_words"] - 9
    assert got[1000]["labels"] == got[1001]["labels"] == "" and got[1000]["score"] < 0.6


def test_chains_against_all_ways():
    """A chain is a row of matches that go on in text and template, none more than the gap apart."""
    one = np.array
    assert licenses.chains([(9, 5, one([4])), (16, 6, one([11]))], 3) == [[5, 17, 12, 11]]
    assert licenses.chains([(9, 5, one([4])), (20, 6, one([11]))], 3) == [[5, 10, 5, 5], [15, 21, 12, 6]]
    assert licenses.chains([(9, 5, one([4])), (11, 5, one([6]))], 3) == [[5, 12, 7, 7]]  # overlaps count once
    assert licenses.chains([(9, 5, one([4, 30])), (16, 6, one([2, 11, 40]))], 3)[0] == [5, 17, 12, 11]
    assert licenses.chains([], 3) == []


def test_refused(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError):
        licenses.scan(docs, [("x", "..")], [])
    with pytest.raises(ValueError):
        licenses.scan(docs, [], [("x", "two words")])
    assert licenses.scan(docs, [], []).first()["score"] == 0
