"""URL filters, language identification, BPE, toxicity and chats."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from figloom.llm import bpe, chat, langid, textblocks, toxicity, urlfilter

PATH = P.path("byte_bpe_50k.tiktoken")


def test_words_and_hashes():
    import pyarrow as pa

    texts = ["a b", None, "", " \t", "b\x0ba  é", "x" * 3000, "a b"]
    for lo, hi, data, offsets in textblocks.text_blocks(pa.chunked_array([texts[:3], texts[3:]]), 16):
        starts, stops, rows = textblocks.word_spans(data, offsets)
        hashes = textblocks.word_hashes(data, starts, stops)
        for i, t in enumerate(texts[lo:hi]):
            words = [bytes(data[a:b]) for a, b in zip(starts[rows[i] : rows[i + 1]], stops[rows[i] : rows[i + 1]], strict=True)]
            assert words == (t or "").encode().split()
            for w, h in zip(words, hashes[rows[i] : rows[i + 1]], strict=True):
                assert h == textblocks.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]


TEXTS = ["", "\x1c a\x1f b ²Ⅷ ½\x85x\xa0 y ", "'s don't\n\n  x   ", "日本語 テキスト é 👩‍👩‍👧", "a" * 3000, "!?" * 2000, "<|endoftext|>", "aaaa" * 9]


def test_ids_are_the_libraries_and_decode_back(spark):
    codec = bpe.Codec(bpe.read_ranks(PATH), P.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    docs = spark.createDataFrame([*enumerate(TEXTS), (90, None), (90, None), (None, "x")], "doc_id long, text string").selectExpr("*", "1 as ids")
    encoded = bpe.encode(docs, PATH, P.PATTERN)
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert got == {i: enc.encode_ordinary(t) for i, t in enumerate(TEXTS)} | {90: [], None: enc.encode_ordinary("x")}
    assert {r["doc_id"]: r["text"] for r in bpe.decode(encoded, PATH, P.PATTERN).collect()} == dict(enumerate(TEXTS)) | {90: "", None: "x"}
    for r in bpe.digests(docs, PATH, P.PATTERN).where("doc_id < 90").collect():
        ids = " ".join(map(str, got[r["doc_id"]]))
        assert (r["n_tokens"], r["ids_sha256"]) == (len(got[r["doc_id"]]), hashlib.sha256(ids.encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(TEXTS[r["doc_id"]].encode()).hexdigest()
    assert bpe.digests(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_forgetting_pieces_changes_nothing():
    small = bpe.Codec(bpe.read_ranks(PATH), P.PATTERN, remember=2)
    large = bpe.Codec(bpe.read_ranks(PATH), P.PATTERN)
    text = "one two three four one five two six seven one" * 3
    assert small.encode(text) == large.encode(text)


def brute_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fit = [(len(r), r, v) for r, v in rules for h, _, p in [r.partition("/")] if h and (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return (host, path, max(fit)[1], max(fit)[2]) if fit else (host, path, None, default)


@pytest.mark.parametrize("broadcast", [100, 0])
def test_url_verdicts(spark, broadcast):
    rng = random.Random(1)
    rules = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("a.b.com/", "block"), ("/nohost", "block")]
    urls = [None, "", "nothing", "http://", "HTTP://EXAMPLE.ORG/es/x?q", "http://x.Example.org/en/12#a", "http://org/", "http://notexample.org", "s://a.b.com", "s://a.b.com/", "s://c.a.b.com/x/y", "s://b.com/?", "s://x?/a", "s://h#://org/"]
    urls += ["http://" + ".".join(rng.choices(["a", "b", "com", "org", "example"], k=3)) + "/" + "/".join(rng.choices(["en", "es", "1"], k=2)) for _ in range(200)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[5]), (None, urls[5])], "page_id long, url string").selectExpr("*", "'x' as verdict", "2 as rule")
    listed = spark.createDataFrame(rules, "rule string, verdict string")
    got = urlfilter.judge(df, listed, broadcast_entries=broadcast).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_verdict(r["url"], rules), r["url"]
    assert {r["verdict"] for r in urlfilter.judge(df, listed.limit(0), "block").collect()} == {"block"}
    assert urlfilter.judge(df.limit(0), listed).count() == 0


def test_languages_on_held_out_texts(spark):
    from figloom.llm.folds import fold

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = langid.fit(docs.where(fold(4) != 2))
    got = langid.predict(docs, models).join(docs.where(fold(4) == 2).select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 .,"), (None, "the of and"), (None, "the of and")], "doc_id long, text string").selectExpr("*", "0 as score")
    found = langid.predict(odd, models).collect()
    assert [r["lang_pred"] for r in found if r["doc_id"]] == ["und"] * 3 and len(found) == 5
    assert langid.fit(docs.limit(0)) == [] and {r["lang_pred"] for r in langid.predict(odd, []).collect()} == {"und"}
    assert langid.predict(docs.limit(0), models).count() == 0


def brute_segments(scores):
    def best(a, b):
        top = None
        for i in range(a, b):
            s = 0
            for j in range(i, b):
                s += scores[j]
                if s > 1e-12 and (top is None or s > top[0] + 1e-9):
                    top = (s, i, j)
        return top

    def go(a, b):
        t = best(a, b) if a < b else None
        return [*go(a, t[1]), t, *go(t[2] + 1, b)] if t else []

    return go(0, len(scores))


def test_all_maximal_segments():
    rng = random.Random(2)
    for _ in range(300):
        scores = [rng.choice([toxicity.QUIET, toxicity.QUIET, rng.uniform(-1, 2)]) for _ in range(rng.randint(0, 14))]
        at = np.array([i for i, x in enumerate(scores) if x != toxicity.QUIET], int)
        got = sorted(toxicity.segments(at, np.array([scores[i] for i in at])), key=lambda x: x[1])
        want = brute_segments(scores)
        assert [x[1:] for x in got] == [x[1:] for x in want]
        assert np.allclose([x[0] for x in got], [x[0] for x in want])


def test_toxic_passages(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        words = rng.choices([f"w{k}" for k in range(150)], k=50)
        if i % 5 == 0:
            words[20:20] = ["vile", "x", "foul"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "a vile foul text")], "doc_id long, text string").selectExpr("*", "1 as n_terms")
    known = spark.createDataFrame([*labels, (None, 1), (1, None), (2, 7), (9999, 1)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    model = toxicity.fit(docs, known, F.lit(True))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert all((got[i] >= 0.5) == (i % 5 == 0) for i in range(400)) and got[900] < 0.5 and got[901] < 0.5 and got[None] >= 0.5
    found = toxicity.passages(docs.where("doc_id < 400"), model).collect()
    assert {r["doc_id"] for r in found} == set(range(0, 400, 5))
    assert all("vile" in rows[r["doc_id"]][1].encode()[r["passage_start"] : r["passage_end"]].decode() for r in found)
    none = toxicity.fit(docs, known.limit(0), F.lit(True))
    assert all(r["score"] < 1e-9 for r in toxicity.score(docs, none, ["doc_id"]).collect())
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).count() == 0


def test_chats_read_back(spark):
    odd = ["", "<|turn|>", "<\\|end|>", "<\\\\|", "a<", "|more|>", "</s>[INST] ok [/INST]", "line\nline", "é 日本 <|says|>x"]
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "<|turn|>"]), rng.choice(odd)) for c in range(30) for t in range(rng.randint(1, 7))]
    rows += [(100, 1, None, None), (100, None, "user", "first"), (100, 1, None, None), (None, 0, "assistant", "nobody")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as formatted", "2 as t")
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    formatted = chat.format_chats(turns)
    back = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert {c: [tuple(t) for t in r["turns"]] for c, r in back.items()} == want
    assert all(r["loss_text"] == "".join(x for role, x in want[c] if role == "assistant") for c, r in back.items())
    adjacent = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(adjacent).first()["formatted"] == "<|turn|>user<|says|>a<|more|>b<|end|><|turn|>assistant<|says|>c<|end|>"
    assert chat.format_chats(turns.limit(0)).count() == 0
