"""The trigram index against `contains` on all texts, and how little of it a search reads."""

import random
import re

import pytest
from pyspark.sql import functions as F

from figloom.operators import trigrams


def texts(seed, n=400):
    rng = random.Random(seed)
    words = ["gold", "Iron", "films", "nm", "rods", "é€😀", "(a)", "a.b", "x\ny", "of", "%_\\"]
    return [(i, None if i % 50 == 7 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(n)]


@pytest.mark.parametrize("few", [True, False])
def test_found_are_those_that_hold_it(spark, tmp_path, monkeypatch, few):
    if not few:
        monkeypatch.setattr(trigrams, "BROADCAST_IDS", -1)
    rows = texts(1) + [(3, "one id, zebra text"), (None, "zebra")]
    df = spark.createDataFrame(rows, "k long, t string")
    trigrams.build(df, "k", "t", str(tmp_path / "i"), 8)
    index = trigrams.open_index(spark, str(tmp_path / "i"), "long", 8)
    for piece in ["gold", "GOLD rods", "d i", "é€😀", "zebra", "nothing", "of of of", "a.b", "x\ny", "%_\\", "m", "", "nm", "one id, zebra text"]:
        want = sorted({i for i, t in rows if i is not None and t is not None and piece.lower() in t.lower()})
        assert sorted(r["id"] for r in index.holding(piece).collect()) == want, piece


def test_a_rare_piece_reads_few_folders(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("k"), F.concat(F.lit("common words of number "), F.md5(F.col("id").cast("string"))).alias("t"))
    index = trigrams.build(df, "k", "t", str(tmp_path / "i"), 32)
    piece = df.where("k = 1234").first()["t"][-12:]
    found = index.holding(piece)
    assert [r["id"] for r in found.collect()] == [1234]
    plan = found._jdf.queryExecution().simpleString()
    folders = {name: re.findall(rf"PartitionFilters: \[[^\]]*?{name}#\d+ (?:IN \(([^)]*)\)|= (\d+))", plan) for name in ("bucket", "part")}
    assert folders["bucket"] and folders["part"]
    assert all(len((a or b).split(",")) <= n for name, n in (("bucket", trigrams.RAREST), ("part", 4)) for a, b in folders[name])


def test_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "k long, t string")
    index = trigrams.build(df, "k", "t", str(tmp_path / "i"), 4)
    assert index.holding("abc").count() == 0 == index.holding("").count()


@pytest.mark.parametrize("few", [True, False])
def test_many_pieces_in_one_pass(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(trigrams, "BLOCK", 16)
    if not few:
        monkeypatch.setattr(trigrams, "BROADCAST_IDS", -1)
    rows = texts(2) + [(3, "one id, zebra text"), (None, "zebra")]
    index = trigrams.build(spark.createDataFrame(rows, "k long, t string"), "k", "t", str(tmp_path / "i"), 8)
    for pieces in (["gold", "GOLD rods", "Gold", "é€😀", "zebra", "nothing", "x\ny", "%_\\"], ["nm", "zebra", ""], ["nothing"], []):
        want = {(i, p) for i, t in rows for p in pieces if i is not None and t is not None and p.lower() in t.lower()}
        assert sorted(map(tuple, index.holding_each(pieces).collect())) == sorted(want)


def test_a_gram_of_all_texts_is_a_row_a_block(spark, tmp_path):
    """The postings stay small where texts are alike; before, each text had a row for each of its grams."""
    df = spark.range(20_000).select(F.col("id").alias("k"), F.lit("a TEM image of gold rods on a carbon film").alias("t"))
    index = trigrams.build(df, "k", "t", str(tmp_path / "i"), 4)
    blocks = index._table("texts").select("block").distinct().count()
    assert 20_000 / trigrams.BLOCK <= blocks <= 20_000 / trigrams.BLOCK + 4
    assert index._table("postings").groupBy("gram").count().agg(F.max("count")).first()[0] == blocks
    assert index.holding("carbon FILM").count() == 20_000
