import numpy as np

from figloom.llm import lm


def corpus(n=300, seed=1):
    rng = np.random.default_rng(seed)
    follows = rng.permutation(60)
    texts = []
    for _ in range(n):
        w, out = int(rng.integers(60)), []
        for _ in range(int(rng.integers(5, 80))):
            out.append(f"t{w}")
            w = int(follows[w]) if rng.random() < 0.9 else int(rng.integers(60))
        texts.append(" ".join(out))
    return texts


def test_order_tells_after_training(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    words = lm.vocabulary(docs)
    assert len(words) == 60
    net = lm.train(docs, words, rounds=6, masked=0.9, rate=0.3)
    rng = np.random.default_rng(2)
    held = corpus(40, seed=1)
    mixed = [" ".join(rng.permutation(t.split())) for t in held]
    both = spark.createDataFrame(list(enumerate(held + mixed)), "doc_id long, text string")
    mean = {r["doc_id"]: r["mean"] for r in lm.score(both, words, net).collect()}
    assert np.mean([mean[i] > mean[i + 40] for i in range(40)]) > 0.9
    assert np.mean(list(mean.values())[:40]) > -np.log(60)


def test_probabilities_sum_to_one_and_gradient_matches():
    net = lm.first_network()
    around = np.array([[1, 2, lm.EDGE, 4]])
    p = [lm.log_probabilities(net, around, np.array([i]))[0] for i in range(lm.SIZE)]
    assert abs(np.exp(p).sum() - 1) < 1e-4
    ids = np.array([77])
    slopes = lm.gradients(net, around, ids)
    for key, index in (("embed", (1, 3)), ("inner", (5, 6)), ("group", (2, 3)), ("term", (2, 4, 13)), ("bias", (7,)), ("term_bias", (2, 13))):
        up, down = ({k: v.astype(np.float64) for k, v in net.items()} for _ in range(2))
        up[key][index] += 1e-4
        down[key][index] -= 1e-4
        slope = (lm.log_probabilities(up, around, ids)[0] - lm.log_probabilities(down, around, ids)[0]) / 2e-4
        assert abs(slope - slopes[key][index]) < 1e-3, key


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a"), (3, "a b c"), (3, "a b c")], "doc_id long, text string").selectExpr("*", "1 as n_terms")
    words = lm.vocabulary(docs)
    found = lm.score(docs, words, lm.train(docs, words)).collect()
    assert len(found) == 5 and {r["log_likelihood"] for r in found if r["doc_id"] in (1, 2)} == {0.0}
    assert lm.score(docs.limit(0), lm.vocabulary(docs.limit(0)), lm.train(docs.limit(0), np.zeros(0, np.uint64))).count() == 0


def test_terms_of_a_shared_output_have_probabilities_of_their_own(spark, monkeypatch):
    common = " ".join(f"c{i} c{i} c{i} c{i} c{i}" for i in range(lm.VOCABULARY))
    rare = [f"r{i}" for i in range(300) for _ in range(i % 4 + 1)]
    docs = spark.createDataFrame([(0, common), *((i + 1, t) for i, t in enumerate(rare))], "doc_id long, text string").repartition(3)
    counts = lm.term_counts(docs)
    words = lm.vocabulary(docs, counts)
    net = lm.train(docs, words)
    asked = spark.createDataFrame([*((i, f"r{i}") for i in range(300)), *((1000 + i, f"c{i}") for i in range(lm.VOCABULARY)), (9999, "never")], "doc_id long, text string")
    got = {r["doc_id"]: r["log_likelihood"] for r in lm.score(asked, words, net, counts).collect()}
    of = {i: int(h >> 32) % lm.OTHERS for i, h in enumerate(next(lm._texts(lm.pa.array([" ".join(f"r{i}" for i in range(300))])))[3].tolist())}
    for i in range(300):
        for j in range(i):
            if of[i] == of[j]:
                assert abs(got[i] - got[j] - np.log((i % 4 + 1) / (j % 4 + 1))) < 1e-6
    assert 0.8 < np.exp([v for k, v in got.items() if k != 9999]).sum() < 1
    assert got[9999] < -np.log(lm.OTHERS)
    for room in (0, 100):
        monkeypatch.setattr(lm, "TABLE", room)
        joined = {r["doc_id"]: r["log_likelihood"] for r in lm.score(asked, words, net, counts).collect()}
        assert joined.keys() == got.keys() and all(abs(joined[k] - got[k]) < 1e-9 for k in got)


def test_rounds_mask_every_place():
    _, _, rows, terms = next(lm._texts(lm.pa.array([*corpus(), None, "", "a a a a a"])))
    for rounds, masked in ((2, 0.15), (7, 0.15), (3, 0.1), (1, 0.15), (6, 0.9)):
        seen = [lm.masked_places(terms, rows, k, rounds, masked) for k in range(rounds)]
        assert set(np.concatenate(seen).tolist()) == set(range(len(terms)))
        assert max(map(len, seen)) < 1.2 * max(masked, 1 / rounds) * len(terms)
