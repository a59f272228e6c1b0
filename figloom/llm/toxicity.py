"""Toxicity: maximum-scoring segments of token log-odds.

Terms (runs of letters, digits and characters beyond ASCII, A-Z lower-cased) get a log-odds weight from labelled texts
under an informative Dirichlet prior; terms that tell little weigh a small negative constant. In each text all maximal
scoring segments are found in one pass, and extreme-value statistics of the clean labelled texts turn the best
segment's sum into the logarithm of how often a clean text of that length reaches it. Adding what the other
significant segments give, a logistic curve over all labelled texts makes a score of it.

The model holds at most `max_terms` terms, whatever the corpus, so it is collected and broadcast. Null and empty texts
have no segment and get the score of one. Labels other than 0 and 1, null labels and labels of unknown documents are left
out; a row is scored once for each time it occurs; with no labels of both kinds every score is next to 0; of terms that
are equally sure, those of the least hash stay; an empty table gives an empty result. Texts may be of any length: they
are read to their end, in time linear in it. Other columns are not read.
"""

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figloom.functions.session import discard, materialise
from figloom.llm.textblocks import LOWER, NOT_TERM, text_blocks, word_hashes, word_spans

#: The weight of terms outside the model: what a passage loses for each of them.
QUIET = -0.03
#: Log-odds are cut off here, so that one term can't carry a text by itself alone.
MOST = 5.0


@dataclass
class Model:
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    decay: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    shift: float = -50.0


def _terms(column):
    for lo, hi, data, offsets in text_blocks(column):
        data = LOWER[data]
        starts, stops, rows = word_spans(data, offsets, NOT_TERM)
        yield lo, hi, starts, stops, rows, word_hashes(data, starts, stops)


def term_counts(labelled: DataFrame) -> DataFrame:
    """term (hash), toxic, clean: texts of each label that hold it; summed in every task before the shuffle.

    A text counts once for a term, so that one that repeats a word hundreds of times doesn't decide its weight."""

    def partial(batches):
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, _, _, rows, terms in _terms(batch.column(0)):
                text = np.repeat(np.arange(hi - lo), np.diff(rows))
                order = np.lexsort((terms, text))
                terms, text = terms[order], text[order]
                once = np.ones(len(terms), bool)
                once[1:] = (terms[1:] != terms[:-1]) | (text[1:] != text[:-1])
                terms, toxic = terms[once], label[lo:hi][text[once]].astype(np.int64)
                unique, inverse = np.unique(terms, return_inverse=True)
                n, t = np.bincount(inverse, minlength=len(unique)), np.bincount(inverse, toxic, len(unique)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(t), pa.array(n - t)], ["term", "toxic", "clean"])

    some = labelled.select("text", F.col("toxic").cast("int").alias("label")).mapInArrow(partial, "term long, toxic long, clean long")
    return some.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_odds(counts: DataFrame, prior: float, least_z: float, least_odds: float, max_terms: int) -> list:
    """The terms that tell most, (term, weight): the weight is the log-odds less least_z standard errors, and at least
    least_odds; max_terms at most. Common words differ by little, if surely, and rare ones by much, but not surely."""
    t, c = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not t or not c:
        return []
    alpha = F.lit(0.5) + F.lit(prior) * (F.col("toxic") + F.col("clean")) / F.lit(t + c)

    def odds(y, n):
        return F.log((y + alpha) / (F.lit(n + prior) - y - alpha))

    delta = odds(F.col("toxic"), t) - odds(F.col("clean"), c)
    error = F.sqrt(1 / (F.col("toxic") + alpha) + 1 / (F.col("clean") + alpha))
    sure = F.abs(delta) - least_z * error
    return counts.select("term", (F.signum(delta) * sure).alias("weight"), sure.alias("sure")).where(F.col("sure") >= least_odds).orderBy(F.desc("sure"), "term").limit(max_terms).collect()


def segments(at: np.ndarray, gains: np.ndarray, quiet: float = QUIET) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (sum, first, last), where the terms at `at` have `gains` and all others `quiet`.

    One pass over the given terms with a stack, as runs of quiet terms only lower the running sum. Each segment knows the
    last one before it whose left sum is less, so that the search for what it may be joined with skips all between, and
    what a join takes off the stack is met once: the pass takes linear time."""
    stack: list[tuple[float, float, int, int, int]] = []  # sum before, sum at its end, first, last, place of the last lesser
    total, last = 0.0, -1
    for i, gain in zip(at.tolist(), gains.tolist(), strict=True):
        total += quiet * (i - last - 1)
        last = i
        before, total = total, total + gain
        if gain <= 0:
            continue
        left, right, first = before, total, i
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                # later segments that ended above the new left side can't be joined any more, but stay as they are
                stack.append((left, right, first, i, j))
                break
            left, _, first, _, lesser = stack[j]
            del stack[j:]
            j = lesser
    return [(r - x, a, b) for x, r, a, b, _ in stack]


def _passages(docs: DataFrame, model: Model, columns: list, schema: str, rows):
    """mapInArrow of rows() over the columns and the text, which comes last where it isn't among them."""
    shared = docs.sparkSession.sparkContext.broadcast((model.terms, model.weights))
    names = [*columns] if "text" in columns else [*columns, "text"]
    place = names.index("text")

    def run(batches):
        known, weights = shared.value
        for batch in batches:
            for lo, hi, starts, stops, begin, terms in _terms(batch.column(place)):
                where = np.searchsorted(known, terms)
                where[where == len(known)] = 0
                hit = np.flatnonzero(known[where] == terms) if len(known) else np.zeros(0, np.int64)
                gains, cut = weights[where[hit]] if len(known) else np.zeros(0), np.searchsorted(hit, begin)
                found = [segments(hit[a:b] - first, gains[a:b]) for a, b, first in zip(cut[:-1], cut[1:], begin[:-1], strict=True)]
                yield rows(batch.slice(lo, hi - lo), found, np.diff(begin), starts, stops, begin)

    return docs.select(*names).mapInArrow(run, schema)


def best_sums(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """columns, n_terms, best: the sum of the best segment of every row's text, 0 where there is none."""

    def rows(part, found, n, *_):
        best = [max([s for s, _, _ in x], default=0.0) for x in found]
        return pa.RecordBatch.from_arrays([*part.columns[: len(columns)], pa.array(n, pa.int64()), pa.array(best, pa.float64())], [*columns, "n_terms", "best"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return _passages(docs, model, columns, f"{kinds}, n_terms long, best double", rows)


def evidence(model: Model, sums: list[float], n_terms: int) -> float:
    """The best segment's log significance and what the others add beyond 0, between -8 and 30."""
    if not sums:
        return -8.0
    floor = model.log_k + math.log(max(n_terms, 1))
    found = sorted((model.decay * s - floor for s in sums), reverse=True)
    return min(max(found[0] + sum(x for x in found[1:] if x > 0), -8.0), 30.0)


def score(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """columns, n_terms, evidence, score of every row; the columns pass through, nothing is shuffled."""

    def rows(part, found, n, *_):
        e = np.array([evidence(model, [s for s, _, _ in x], k) for x, k in zip(found, n, strict=True)])
        p = 1 / (1 + np.exp(-(model.slope * e + model.shift)))
        return pa.RecordBatch.from_arrays([*part.columns[: len(columns)], pa.array(n, pa.int64()), pa.array(e), pa.array(p)], [*columns, "n_terms", "evidence", "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return _passages(docs, model, columns, f"{kinds}, n_terms long, evidence double, score double", rows)


def passages(docs: DataFrame, model: Model, least: float = 3.0) -> DataFrame:
    """doc_id, passage_start, passage_end (bytes of the UTF-8 text), significance of each passage that is at least `least`."""

    def rows(part, found, n, starts, stops, begin):
        out = []
        base = np.concatenate([[0], np.cumsum([len((t or "").encode()) for t in part.column(1).to_pylist()])])
        for d, segs in enumerate(found):
            for s, a, b in segs:
                if (e := model.decay * s - model.log_k - math.log(max(n[d], 1))) >= least:
                    out.append((part.column(0)[d].as_py(), int(starts[begin[d] + a] - base[d]), int(stops[begin[d] + b] - base[d]), e))
        ids, a, b, e = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(e, pa.float64())], ["doc_id", "passage_start", "passage_end", "significance"])

    return _passages(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, ["doc_id", "text"], "doc_id long, passage_start long, passage_end long, significance double", rows)


def _logistic(x: np.ndarray, n1: np.ndarray, n0: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through counted positives and negatives at x; lightly shrunk, never falling."""

    def loss(v):
        y = v[0] * x + v[1]
        return (n1 * np.logaddexp(0, -y) + n0 * np.logaddexp(0, y)).sum() + 0.05 * v[0] ** 2 + 0.005 * v[1] ** 2

    at, m = np.array([0.5, 0.0]), n1 + n0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(at[0] * x + at[1], -30, 30)))
        w = m * p * (1 - p)
        g = np.array([((n1 - m * p) * x).sum() - 0.1 * at[0], (n1 - m * p).sum() - 0.01 * at[1]])
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        while loss(at + step) > loss(at) and abs(step).max() > 1e-9:
            step = step / 2
        at = at + step
        if abs(step).max() < 1e-7:
            break
    return max(float(at[0]), 0.0), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, learnable, prior: float = 500.0, least_z: float = 2.0, least_odds: float = 1.0, max_terms: int = 100_000, max_labels: int = 250_000) -> Model:
    """A model of the labelled texts; labels has doc_id and toxic, used where learnable.

    It is fitted on max_labels labelled texts at most, those of the least hashes of their ids. So few are broadcast, and
    the texts stay where they are."""
    known = labels.where(learnable).where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = max_labels / max(known.count(), max_labels)
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < 1.05 * share * 1_000_003)
        known = known.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)), "doc_id").limit(max_labels)
    known = F.broadcast(known)
    texts = docs.where("text is not null").select("doc_id", "text").join(known, "doc_id").select("toxic", "text")
    model = Model()
    counts = materialise(term_counts(texts))
    found = log_odds(counts, prior, least_z, least_odds, max_terms)
    discard(counts)
    if not found:
        return model
    terms = np.array([r["term"] for r in found], np.int64).view(np.uint64)
    weights = np.clip([r["weight"] for r in found], -1.0, MOST)
    order = np.argsort(terms)
    model.terms, model.weights = terms[order], weights[order]
    # Gumbel law of the best sum less log(length), by its median and 95th percentile over the clean texts.
    best = best_sums(texts, model, ["toxic"]).where("toxic = 0 and n_terms > 0")
    law = best.agg(F.percentile_approx("best", [0.5, 0.95], 10_000).alias("q"), F.avg(F.log("n_terms")).alias("log_n")).first()
    if law["q"] is not None:
        middle, high = law["q"]
        model.decay = 1 / max((high - middle) / 2.6037, 0.5)
        model.log_k = model.decay * middle - 0.3665 - law["log_n"]
    told = score(texts, model, ["toxic"]).groupBy(F.round("evidence", 1).alias("x"))
    bins = told.agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0")).orderBy("x").collect()
    model.slope, model.shift = _logistic(*(np.array([r[k] for r in bins], float) for k in ("x", "n1", "n0")))
    return model
