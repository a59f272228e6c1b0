import random
from collections import Counter

import pytest

from figloom.llm import substrings


def brute(rows, width):
    seen, words_of = Counter(), [(t or "").encode().split() for _, t in rows]
    for w in words_of:
        seen.update(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, words_of, strict=True):
        cut = {i + k for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for k in range(width)}
        out.append((d, b" ".join(x for i, x in enumerate(w) if i not in cut).decode(), len(w), len(cut)))
    return sorted(out, key=repr)


def run(spark, rows, width, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as h", "'x' as mini")
    return sorted([tuple(r) for r in substrings.remove_repeats(docs, width, **more).collect()], key=repr)


@pytest.mark.parametrize("width,late", [(5, 1000), (8, 3), (35, 1000), (35, 5)])
def test_matches_brute_force(spark, width, late):
    rng = random.Random(width + late)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.randint(0, 120))
        if i % 3 == 0:
            at = rng.randint(0, len(words))
            a, b = sorted(rng.sample(range(61), 2))
            words[at:at] = passage[a:b] if i % 2 else passage
        rows.append((i, " ".join(words)))
    rows += [(200, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (201, None), (202, ""), (203, "a " * 500), (204, "a b " * 300), (205, " \t".join(vocabulary) + "\n"), (206, " ".join(vocabulary[:40] * 2))]
    assert run(spark, rows, width, late_count=late) == brute(rows, width)


def test_empty(spark):
    assert run(spark, [], 35) == []
