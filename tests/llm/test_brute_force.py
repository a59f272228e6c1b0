"""The operators that SQL can't express, held against plain Python on small tables; very long texts, ties and clashing names."""

import math
import random
import re
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F

from figloom.llm import bpe, chat, jaccard, langid, lm, queries, rules, substrings, toxicity, urlfilter
from figloom.llm.folds import fold
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_substrings import brute as repeats
from tests.llm.test_texts import brute_segments

D = "/root/testdata/sf0.001"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_url_lengths_belong_to_their_hosts(spark):
    listed = [(f"h{i}.org/" + "p" * (i % 7), "block") for i in range(60)] + [("org/", "allow"), ("a.b.h3.org/ppp/q", "allow"), ("nohost", "block"), ("/x", "block")]
    urls = [f"http://{s}h{i}.org/{'p' * k}" for i in range(0, 60, 5) for k in (0, 3, 6) for s in ("", "a.b.", "x")] + ["http://a.b.h3.org/ppp/q?x", "http://h1.org", "no url", None, "http://h6.org/" + "p" * 300_000, "http://" + "s." * 2_000 + "h6.org/pppppp#z"]

    def want(url):
        if url is None or "://" not in url:
            return None
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        fits = [r for r, _ in listed if "/" in r[1:] and (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        return max(fits, key=len, default=None)

    got = urlfilter.judge(frame(spark, list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' as rule", "'y' as candidate"), frame(spark, listed, "rule string, verdict string"))
    assert {r["page_id"]: r["rule"] for r in got.collect()} == {i: want(u) for i, u in enumerate(urls)}


def test_near_copies_of_very_long_texts_with_clashing_names(spark):
    rng = random.Random(7)
    long = [f"w{rng.randrange(5000)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join([*long[:500], "new", *long[500:]])), (3, " ".join(long[:40_000])), (4, "short one here"), (4, "short one here"), (5, None)]
    docs = frame(spark, rows).selectExpr("*", "1 as class_id", "2 as component_id", "3 as n", "'s' as sig")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(docs, 3, 90).collect()}
    assert got == groups(rows, 3, 90)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_families_of_variants(spark, monkeypatch, seed):
    """Copies of copies: classes apart from the hub that link with each other, or with others than the hub."""
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", 2)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]

    def edited(base, n):
        out = list(base)
        for _ in range(n):
            out[rng.randrange(len(out))] = rng.choice(words)
        return out

    base = rng.choices(words, k=150)
    variants = [base, *(edited(base, rng.randint(1, 6)) for _ in range(4))]
    rows = [(i, " ".join(edited(rng.choice(variants), rng.randint(0, 4)))) for i in range(110)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link(frame(spark, rows), 3, 90).collect()}
    assert got == groups(rows, 3, 90)


def test_windows_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(substrings, "_window_hashes", lambda words, width: words[: len(words) - width + 1] % np.uint64(3))
    rng = random.Random(4)
    words = rng.choices([f"w{i}" for i in range(9)], k=400)
    at, rows = np.arange(390), np.array([int(w[1:]) for w in words], np.uint64)
    order, cuts = substrings._equal_windows(rows, at, 5)
    runs = [tuple(sorted(order[a:b].tolist())) for a, b in zip(cuts, cuts[1:])]
    want = {}
    for i in at.tolist():
        want.setdefault(tuple(words[i : i + 5]), []).append(i)
    assert sorted(runs) == sorted(tuple(v) for v in want.values())


def test_buckets_that_are_counted_as_they_come(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 400)
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(14)]
    rows = [(i, " ".join([*rng.choices(["a", "b", "c", "d"], k=rng.randint(0, 9)), *passage[rng.randint(0, 3) :], *rng.choices(["a", "b", "c"], k=5)])) for i in range(200)]
    rows.append((900, " ".join(rng.choices([f"w{i}" for i in range(40)], k=40_000))))
    docs = frame(spark, rows).repartition(1)
    for late in (2, 10_000):
        got = sorted([tuple(r) for r in substrings.remove_repeats(docs, 8, late_count=late).collect()], key=repr)
        assert got == repeats(rows, 8)


def test_language_is_that_of_the_smallest_sum(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text", "lang")
    models = langid.fit(docs.where(fold(4) != 2))
    compressors = []
    for lang, content in models:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(7, source_size=langid.BLOCK_BYTES, dict_size=len(content), min_match=3, write_content_size=False, write_dict_id=False)
        d.precompute_compress(compression_params=params)
        compressors.append((lang, zstandard.ZstdCompressor(dict_data=d, compression_params=params)))

    def want(text):
        letters = re.sub(" +", " ", "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower())).strip().encode()
        if not letters:
            return "und"
        sizes = [sum(len(c.compress(letters[i : i + langid.BLOCK_BYTES])) for i in range(0, len(letters), langid.BLOCK_BYTES)) for _, c in compressors]
        return compressors[sizes.index(min(sizes))][0]

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10_001, "lorem ipsum dolor " * 40_000), (10_002, None)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(frame(spark, rows), models).collect()}
    assert got == {i: want(t) for i, t in rows}
    tied = langid.predict(frame(spark, rows[:5]), [("zz", models[0][1]), ("aa", models[0][1])]).collect()
    assert {r["lang_pred"] for r in tied} <= {"zz", "und"} and all(r["rejected"] for r in tied)


def test_bpe_of_very_long_pieces(spark):
    table = bpe.read_ranks(public_tokenizers.path(queries.TOKENIZER))
    codec = bpe.Codec(table, public_tokenizers.PATTERN, remember=50)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(8)
    texts = ["x" * 200_000, "".join(rng.choices("abcdefgh", k=1_000_000)), "".join(rng.choices("ab", k=64)), "".join(rng.choices("ab", k=65)), "é" * 33, "word " * 3000, "", " ", *("".join(rng.choices("abcé 1!\n漢", k=rng.randint(1, 90))) for _ in range(300))]
    assert codec.encode_all(texts) == [known.encode_ordinary(t) for t in texts]
    assert len(codec.ids) < 2000
    for size in (1, 2, 3, 5, 16, 17, 40, 63, 64):
        pieces = [bytes(rng.choices(b"aber th\xc3\xa9", k=size)) for _ in range(50)]
        assert [list(x) for x in bpe.merge_many(pieces, codec.pairs)] == [bpe.merge(p, codec.ranks) for p in pieces]


def test_scan_takes_linear_time():
    import time

    n = 200_000
    began = time.process_time()
    found = toxicity.segments(np.arange(n) * 60, np.full(n, 1.0))
    assert time.process_time() - began < 2 and len(found) == n
    rng = np.random.default_rng(3)
    toxicity.segments(np.arange(n) * 3, rng.normal(0, 1, n))
    assert time.process_time() - began < 4


def test_toxicity_scores_against_plain_python(spark):
    """The model and all scores of a small table, from counts of terms to the logistic curve."""
    rng = random.Random(9)
    rows, labels = [], {}
    for i in range(260):
        text = rng.choices([f"w{k}" for k in range(40)], k=rng.randint(0, 40))
        if i % 4 == 0:
            for _ in range(rng.randint(1, 4)):
                text.insert(rng.randrange(len(text) + 1), rng.choice(["vile", "foul", "mean"]))
        if i % 9 == 0:
            text.insert(0, "foul")
        rows.append((i, " ".join(text)))
        if i % 5:
            labels[i] = int(i % 4 == 0)
    rows.append((300, "calm " * 30_000 + "vile foul mean vile foul"))
    model = toxicity.fit(frame(spark, rows), frame(spark, list(labels.items()), "doc_id long, toxic int"), F.lit(True), prior=50.0)
    toxic = {d: set(t.split()) for d, t in rows if labels.get(d) == 1}
    clean = {d: set(t.split()) for d, t in rows if labels.get(d) == 0}
    n1, n0 = sum(map(len, toxic.values())), sum(map(len, clean.values()))
    weight = {}
    for term in set().union(*toxic.values(), *clean.values()):
        y1, y0 = sum(term in s for s in toxic.values()), sum(term in s for s in clean.values())
        a = 0.5 + 50 * (y1 + y0) / (n1 + n0)
        delta = math.log((y1 + a) / (n1 + 50 - y1 - a)) - math.log((y0 + a) / (n0 + 50 - y0 - a))
        sure = abs(delta) - 2 * math.sqrt(1 / (y1 + a) + 1 / (y0 + a))
        if sure >= 1:
            weight[term] = max(-1.0, min(5.0, math.copysign(sure, delta)))
    assert {"vile", "foul", "mean"} >= set(weight) and len(weight) >= 2

    def sums(text):
        words = text.split()
        if len(words) > 1000:
            words = words[-12:]
        return [s for s, _, _ in brute_segments([weight.get(w, toxicity.QUIET) for w in words])]

    best = sorted(max(sums(t), default=0.0) for d, t in rows if labels.get(d) == 0 and t)
    middle, high = best[math.ceil(len(best) * 0.5) - 1], best[math.ceil(len(best) * 0.95) - 1]
    decay = 1 / max((high - middle) / 2.6037, 0.5)
    log_k = decay * middle - 0.3665 - np.mean([math.log(len(t.split())) for d, t in rows if labels.get(d) == 0 and t])
    assert model.decay == pytest.approx(decay) and model.log_k == pytest.approx(log_k)

    def evidence(text):
        found = sorted((decay * s - log_k - math.log(max(len(text.split()), 1)) for s in sums(text)), reverse=True)
        return min(max(found[0] + sum(x for x in found[1:] if x > 0), -8.0), 30.0) if found else -8.0

    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame(spark, rows), model, ["doc_id"]).collect()}
    for d, t in rows:
        assert got[d] == pytest.approx(1 / (1 + math.exp(-(model.slope * evidence(t) + model.shift)))), d
    told = [(round(evidence(t), 1), labels[d]) for d, t in rows if d in labels]

    def loss(slope, shift):
        return sum(np.logaddexp(0, -(slope * x + shift) if y else slope * x + shift) for x, y in told) + 0.05 * slope**2 + 0.005 * shift**2

    here = loss(model.slope, model.shift)
    assert all(loss(model.slope + a, model.shift + b) >= here - 1e-6 for a, b in ((0.02, 0), (-0.02, 0), (0, 0.02), (0, -0.02)))


def test_lm_scores_against_plain_python(spark):
    rng = random.Random(10)
    rows = [(i, " ".join(rng.choices([f"t{k}" for k in range(30)], k=rng.randint(0, 25)))) for i in range(40)] + [(50, "t1 t2 " * 20_000), (51, "never seen")]
    docs = frame(spark, rows)
    counts = lm.term_counts(docs)
    words = lm.vocabulary(docs, counts)
    net = {k: v.astype(float) for k, v in lm.train(docs, words).items()}
    got = {r["doc_id"]: (r["n_terms"], r["log_likelihood"]) for r in lm.score(docs, words, {k: v.astype(np.float32) for k, v in net.items()}, counts).collect()}
    place = {int(h): i for i, h in enumerate(words)}
    hashes = {t: int(h) for t, h in zip([f"t{k}" for k in range(30)] + ["never", "seen"], next(lm._texts(pa.array([" ".join([f"t{k}" for k in range(30)] + ["never", "seen"])])))[3].tolist())}
    for d, text in rows:
        ids = [place[hashes[t]] for t in text.split()[:60]]
        total = 0.0
        for i, own in enumerate(ids):
            around = [ids[i + s] if 0 <= i + s < len(ids) else lm.EDGE for s in lm.SIDES]
            hidden = np.tanh(np.concatenate([net["embed"][a] for a in around]) @ net["inner"] + net["bias"])
            a = hidden @ net["group"] + net["group_bias"]
            b = hidden @ net["term"][own // lm.CLASSES] + net["term_bias"][own // lm.CLASSES]
            total += a[own // lm.CLASSES] - np.log(np.exp(a).sum()) + b[own % lm.CLASSES] - np.log(np.exp(b).sum())
        if len(text.split()) <= 60:
            assert got[d] == (len(ids), pytest.approx(total, rel=1e-4, abs=1e-4)), d
    assert got[50][0] == 40_000


def test_lm_does_not_depend_on_how_rows_lie(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choices([f"t{k}" for k in range(25)], k=30))) for i in range(300)]
    means = []
    for parts in (1, 6):
        docs = frame(spark, rows).repartition(parts, "doc_id")
        counts = lm.term_counts(docs)
        words = lm.vocabulary(docs, counts)
        means.append({r["doc_id"]: r["mean"] for r in lm.score(docs, words, lm.train(docs, words), counts).collect()})
    assert abs(np.mean([means[0][d] - means[1][d] for d in means[0]])) < 0.3


def test_verdicts_follow_the_measures_and_the_list(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    found = rules.fit_and_judge(docs.selectExpr("*", "true as kept", "'x' as rule"), labels)
    listed = rules.learn(*rules._cells(rules.shares(rules.measures(docs)).join(labels.where("quality in (0, 1)"), "doc_id")))
    for r in found.collect():
        base = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        values = {k: (r[v.split(" / ")[0]] / r[v.split(" / ")[1]] if r[v.split(" / ")[1]] else 0.0) if " / " in v else float(r[v]) for k, v in rules.SHARES.items()}
        rule = next((rules.as_text(x) for x in listed if all(values[k] > t if op == ">" else values[k] <= t for k, op, t in x)), None)
        assert (r["base_failed"], r["rule"], r["kept"]) == (base, rule, not base and rule is None)


def test_repeats_behind_equal_hashes(spark, monkeypatch):
    monkeypatch.setattr(rules.F, "xxhash64", lambda *c: F.lit(5).cast("long"))
    rng = random.Random(12)
    texts = [" ".join(rng.choices("abcd", k=rng.randint(0, 60))) for _ in range(30)]
    from tests.llm.test_rules import brute

    got = {r["doc_id"]: r["n_repeat_words"] for r in rules.measures(frame(spark, list(enumerate(texts)))).collect()}
    assert got == {i: brute(t)[4] for i, t in enumerate(texts)}


def test_chats_of_very_long_texts(spark):
    rows = [(1, 0, "user", "<|end|>\\" * 100_000), (1, 1, "assistant", "a<\\|" * 200_000)]
    back = chat.read_back(chat.format_chats(frame(spark, rows, "conv_id long, turn long, role string, text string"))).first()
    assert [tuple(t) for t in back["turns"]] == [(r, t) for _, _, r, t in rows] and back["loss_text"] == rows[1][3]
