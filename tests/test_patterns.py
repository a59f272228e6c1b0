"""The many-pattern automaton against plain search, with many terms and long texts, and what the plans look like."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from figloom.operators import captions, patterns


@pytest.mark.parametrize("seed", range(4))
def test_against_plain_search(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(patterns, "DENSE", [1, 4, 50, 10_000][seed])
    monkeypatch.setattr(patterns, "LANE", [1, 3, 20, 512][seed])
    monkeypatch.setattr(patterns, "BLOCK", [10, 300, 8 << 20, 8 << 20][seed])
    for _ in range(60):
        letters = rng.choice(["ab", "abcé", "aü€😀"])
        told = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 25))}, key=str.encode)
        texts = [None if rng.random() < 0.1 else "".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(20)]
        row, which = patterns.Automaton([t.encode() for t in told]).held(pa.array(texts, pa.string()))
        want = [(i, k) for i, t in enumerate(texts) for k, p in enumerate(told) if t is not None and p in t]
        assert list(zip(row.tolist(), which.tolist(), strict=True)) == want


def test_a_hundred_thousand_terms():
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 18))) for _ in range(100_000)})
    began = time.time()
    a = patterns.Automaton([w.encode() for w in words])
    texts = [" ".join(rng.choice(words) for _ in range(20)) for _ in range(300)] + ["".join(rng.choice("abcdefghijklmnopq ") for _ in range(400_000))]
    row, which = a.held(pa.array(texts))
    assert time.time() - began < 60
    found = [set() for _ in texts]
    for r, w in zip(row.tolist(), which.tolist(), strict=True):
        found[r].add(words[w])
    for t, f in zip(texts[:40], found[:40], strict=True):
        assert f == {w for w in words if w in t}
    assert {w for w in found[-1]} == {w for w in words if w in texts[-1]}


def test_repeating_text_and_pattern_take_linear_time():
    began = time.time()
    row, which = patterns.Automaton([b"a" * n for n in range(1, 200)]).held(pa.array(["a" * 500_000, "b" * 500_000, "a" * 50]))
    assert time.time() - began < 30
    assert (np.bincount(row, minlength=3) == [199, 0, 50]).all()


def test_labels_blocks_and_edges(spark):
    df = spark.createDataFrame([(1, "gold rods on a film"), (2, None), (3, ""), (4, "Gold"), (1, "gold rods on a film")], "k long, t string")
    terms = spark.createDataFrame([("m", "gold"), ("metal", "gold"), ("m", "rod"), ("x", None), (None, "rod"), ("e", ""), ("s", "m of"), ("f", " film")], "term string, synonym string")
    want = sorted([(1, "m"), (1, "metal"), (1, "f")] * 2)
    assert sorted(tuple(r) for r in captions.tag(df, "k", "t", terms).collect()) == want
    told = terms.select(F.col("synonym").alias("pattern"), F.col("term").alias("label"))
    for most in (1, 8, 10_000):
        got = patterns.with_held(df, "t", told, most_bytes=most)
        assert sorted((r["k"], x) for r in got.collect() for x in r["held"]) == want
    assert captions.tag(df, "k", "t", terms, skip_empty=False).where("term = 'e'").count() == 3
    assert captions.tag(df, "k", "t", terms.limit(0)).count() == 0 == captions.tag(df.limit(0), "k", "t", terms).count()


def test_no_nested_loop(spark):
    spans = spark.createDataFrame([(1, "(CO2)"), (2, "(a)"), (3, None)], "k long, span string")
    names = spark.createDataFrame([("CO2",), ("H2O",), (None,)], "name string")
    left = captions.drop_molecules(spans, names)
    assert sorted(r["k"] for r in left.collect()) == [2, 3]
    assert "NestedLoop" not in left._jdf.queryExecution().toString() and "Cartesian" not in left._jdf.queryExecution().toString()
