"""The Merkle manifest against trees built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from figloom.llm import manifest, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    """The root, and each leaf's siblings, level by level: (left, right)."""
    ways, level, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i - i % 3
            ways[k].append(("".join(level[run:i]), "".join(level[i + 1 : run + 3])))
        level, at = [h(*level[i : i + 3]) for i in range(0, len(level), 3)], [i // 3 for i in at]
    return level[0], ways


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))) for s in order}
    built = {s: tree([leaf(r) for r in rs]) for s, rs in trees.items()}
    root, above = tree([built[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for r, way in zip(trees[s], built[s][1], strict=True):
            way = way + above[k]
            other = leaf((*r[:4], r[4].replace("\n", ""))) if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else leaf(r)
            for left, right in way:
                other = h(left, other, right)
            out.append((r[0], leaf(r), built[s][0], root, h(*(x for w in way for x in w)), other, other == root))
    return sorted(out, key=repr)


def found(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as s", "1 as g").write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op11_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)


def rows(sizes, seed=1):
    rng = random.Random(seed)
    out = [(100 * k + i, s, rng.choice(["en", None]), rng.choice([7, None]), rng.choice([None, "", "é\nb", "a\n\n" * rng.randint(0, 3), "plain"])) for k, (s, n) in enumerate(sizes) for i in range(n)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("sizes", [[("a", 1)], [("a", 3), (None, 1)], [("b", 4), ("", 2), ("é", 90), (None, 7), ("z", 82)], [(f"s{i}", 1 + i % 3) for i in range(84)]], ids=["one", "two", "uneven", "many"])
def test_proofs_are_those_of_plain_trees(spark, tmp_path, sizes):
    r = rows(sizes)
    assert found(spark, r, tmp_path) == brute(r)


def test_shuffled_joins_give_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "BROADCAST_NODES", 0)
    monkeypatch.setattr(manifest, "BROADCAST_RUNS", 0)
    r = rows([("a", 300), ("b", 2), (None, 9)], 2)
    assert found(spark, r, tmp_path) == brute(r)


def test_null_and_repeated_rows(spark, tmp_path):
    r = [(None, None, None, None, None)] * 2 + [(5, "a", "en", 1, "x\ny")] * 5 + [(5, "a", "en", 2, "x\ny"), (None, "a", None, 3, ""), (9, "a", None, 3, "long " * 200_000)]
    assert found(spark, r, tmp_path) == brute(r)


def test_empty_table(spark, tmp_path):
    assert found(spark, [], tmp_path) == []


def test_tampering_shows(spark):
    docs = spark.createDataFrame(rows([("a", 40), ("b", 5)]), SCHEMA)
    told = manifest.proofs(docs).withColumn("again", manifest.fold(F.col("leaf"), F.col("segment"))).withColumn("wrong", manifest.fold(F.sha2(F.lit("x").cast("binary"), 256), F.col("segment")))
    assert told.where("again != root or wrong = root").count() == 0
