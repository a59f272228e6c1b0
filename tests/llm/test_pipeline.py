import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from figloom.llm import decontaminate, substrings
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_substrings import brute as repeats

D = "/root/testdata/sf0.001"


def test_stages_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = corpus_pipeline.near_duplicates(spark, docs, D)
    assert out.columns == docs.columns
    want = {d for d, (_, c) in groups(list(before.items()), 5, 80).items() if d == c}
    assert {r["doc_id"] for r in out.collect()} == want
    cut = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_passages(spark, docs, D).collect()}
    assert cut == {d: (kept if n else before[d]) for d, kept, _, n in repeats(list(before.items()), 50) if kept or not n}
    end = corpus_pipeline.run(spark, D)
    assert 0 < end.count() <= len(want) and set(end.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_toxic_and_leaking_texts_go(spark, tmp_path):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(200)]
    item = " ".join(rng.choices(words, k=30))
    rows, labels = [], []
    for i in range(400):
        text = rng.choices(words, k=60)
        if i % 4 == 0:
            for _ in range(3):
                text.insert(rng.randrange(60), rng.choice(["vile", "nasty", "foul"]))
        labels.append((i, 1, int(i % 4 == 0)))
        rows.append((i, " ".join(text) + (" " + item if i % 50 == 1 else ""), "en", "s", 1))
    rows += [(900, None, None, None, None), (None, "plain words", None, None, None), (901, "", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = corpus_pipeline.toxic(spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in clean} == {r[0] for r in rows if r[0] is None or r[0] >= 400 or r[0] % 4}
    left = corpus_pipeline.benchmark_leaks(spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in left} == {r[0] for r in rows if r[0] is None or r[0] >= 400 or r[0] % 50 != 1}
    stray = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(f"so {item} then").alias("text"), "lang", "source", "n_chars")
    assert corpus_pipeline.benchmark_leaks(spark, docs.union(stray), str(tmp_path)).where("doc_id is null").count() == 1
    assert corpus_pipeline.run(spark, str(tmp_path)).where("doc_id in (900, 901)").count() == 2


def test_repeated_rows_clashing_ids_and_columns(spark):
    rng = random.Random(6)
    long = " ".join(f"w{rng.randrange(9000)}" for _ in range(50_000))
    a, b = (" ".join(rng.choices("abcdefghijkl", k=60)) for _ in range(2))
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, b, "en", "s", 1), (2, a, "en", "s", 1), (None, a, "en", "s", 1), (None, b + " end", "en", "s", 1), (None, None, "en", "s", 1), (None, None, "en", "s", 1), (3, long, "en", "s", 1), (4, long + " more", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as _key", "2 as component_id", "'x' as kept")
    out = corpus_pipeline.near_duplicates(spark, docs, D)
    assert out.columns == corpus_pipeline.COLUMNS
    assert sorted([(r["doc_id"], r["text"]) for r in out.collect()], key=repr) == sorted([(1, a), (1, b), (None, None), (None, None), (3, long)], key=repr)
    cut = corpus_pipeline.repeated_passages(spark, docs.where("doc_id > 2"), D).collect()
    assert [(r["doc_id"], r["text"], r["n_chars"]) for r in cut] == [(4, "more", 4)]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty_table(spark, name, stage):
    empty = spark.read.parquet(f"{D}/documents.parquet").limit(0)
    assert stage(spark, empty, D).count() == 0


def test_one_python_worker_a_task(spark, monkeypatch):
    """Idle workers stay and take turns, so a task with two of them doubles what an executor holds from then on."""
    plans = []

    def build(keys, *a, f=substrings.bloom.build, **k):
        plans.append(keys._jdf.queryExecution().executedPlan().toString())
        return f(keys, *a, **k)

    monkeypatch.setattr(substrings.bloom, "build", build)
    docs = spark.read.parquet(f"{D}/documents.parquet")
    corpus_pipeline.repeated_passages(spark, docs, D).count()
    assert len(plans) == 1 and "MapInArrow" not in plans[0]
    found = decontaminate.leaks(docs, spark.read.parquet(f"{D}/benchmark.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ExistingRDD" not in plan
