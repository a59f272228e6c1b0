import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from figloom.llm import rules

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "a a a a a", " x\ny\n x\n\n\nx", "é ü #1 <b>|$%&*", "one\x0btwo\x1cthree", "a b c d " * 5000, "z" * 100_000]


def test_measures_match_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "1 as n_words", "'x' as _t")
    got = {r["doc_id"]: tuple(r[k] for k in NAMES) for r in rules.measures(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("ab \n\t|", max_size=60), min_size=1, max_size=20))
def test_measures_match_on_random_texts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r[k] for k in NAMES) for r in rules.measures(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: tuple(r[k] for k in NAMES) for r in rules.measures(docs).collect()} == {i: brute(t) for i, t in texts.items()}


def test_learned_list_agrees_with_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    found = rules.fit_and_judge(docs, labels).join(labels, "doc_id").collect()
    assert sum((r["rule"] is None) == (r["quality"] == 1) for r in found) > 0.9 * len(found)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = rules.fit_and_judge(docs, none).collect()
    assert len(found) == 3 and not any(r["kept"] for r in found) and all(r["rule"] is None for r in found)
    odd = spark.createDataFrame([(1, None), (None, 1), (1, 7)], "doc_id long, quality int")
    assert rules.fit_and_judge(docs.limit(0), odd).count() == 0
