"""LM scoring by masked pseudo-likelihood.

A small network sees the two terms before and the two after a place and predicts the term that stands there: embeddings,
one tanh layer, and a softmax in two steps (class, then term in the class). A text's score is the sum of the conditional
log-probabilities of all its terms, each from both sides. Terms are runs of letters, digits and characters beyond
ASCII, A-Z lower-cased; the commonest `VOCABULARY` of the whole corpus have outputs of their own, the rest share OTHERS
by a hash. A term of a shared output has the output's probability times its own inside it: its count over the counts of
all the output's terms and one more, which is what a term that wasn't counted gets. All terms of the corpus are counted;
the counts of up to TABLE of them are broadcast for scoring, rarer ones are joined to the texts that hold them.

Everything is trained on all texts: term counts are summed in each task and then by Spark, and in each of `rounds`
passes every task takes gradient steps over the masked places of its own texts (a share of them, drawn by a hash and
another one each round, so that the rounds together mask every place), after which Spark averages the tasks' networks,
weighted by places. A network has a fixed number of parameters: as contexts, terms of a shared output look alike.

Each task trains on the rows of its own partition, so the network depends a little on how rows lie in partitions: the same
files give the same scores, the same rows dealt otherwise give scores that differ slightly.

Null and empty texts have no terms and score 0, with mean 0. Repeated rows are scored alike; ids may be null; of terms
equally frequent that of the least hash comes first; texts may be of any length, as places are trained on and scored in
batches; other columns are not read, whatever their names; an empty corpus leaves the first network.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figloom.functions.session import materialise
from figloom.llm.textblocks import LOWER, NOT_TERM, mix, text_blocks, word_hashes, word_spans

CLASSES = 32
SIZE = CLASSES * CLASSES
OTHERS = 64
VOCABULARY = SIZE - OTHERS
EDGE = SIZE
SIDES = (-2, -1, 1, 2)
WIDTH, HIDDEN = 16, 32
#: Places that are scored at a time, and that make one step of training.
BATCH, STEP = 4096, 2048
#: Counts that are broadcast for scoring.
TABLE = 1 << 20
SHAPES = {"embed": (SIZE + 1, WIDTH), "inner": (len(SIDES) * WIDTH, HIDDEN), "bias": (HIDDEN,), "group": (HIDDEN, CLASSES), "group_bias": (CLASSES,), "term": (CLASSES, HIDDEN, CLASSES), "term_bias": (CLASSES, CLASSES)}


def first_network(seed: int = 8) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {k: (np.zeros(s) if "bias" in k else rng.normal(0, 0.1 if k == "embed" else s[-2] ** -0.5, s)).astype(np.float32) for k, s in SHAPES.items()}


def flat(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in SHAPES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        out[k] = values[at : at + int(np.prod(s))].reshape(s).astype(np.float32)
        at += int(np.prod(s))
    return out


def _texts(column: pa.Array):
    for lo, hi, data, offsets in text_blocks(column):
        data = LOWER[data]
        starts, stops, rows = word_spans(data, offsets, NOT_TERM)
        yield lo, hi, rows, word_hashes(data, starts, stops)


def term_counts(docs: DataFrame) -> DataFrame:
    """term (its hash), n of every term of all texts."""

    def partial(batches):
        for batch in batches:
            for _, _, _, terms in _texts(batch.column(0)):
                term, n = np.unique(terms, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], ["term", "n"])

    return materialise(docs.select("text").mapInArrow(partial, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")))


def vocabulary(docs: DataFrame, counts: DataFrame | None = None) -> np.ndarray:
    """Hashes of the terms with outputs of their own, the commonest of all texts first; VOCABULARY at most."""
    counts = term_counts(docs) if counts is None else counts
    return np.array([r["term"] for r in counts.orderBy(F.desc("n"), "term").limit(VOCABULARY).collect()], np.int64).view(np.uint64)


def numbered(terms: np.ndarray, known: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The outputs of terms; known is sorted, rank is the output of each."""
    out = (VOCABULARY + (terms >> np.uint64(32)) % np.uint64(OTHERS)).astype(np.int64)
    if len(known):
        where = np.minimum(np.searchsorted(known, terms), len(known) - 1)
        hit = known[where] == terms
        out[hit] = rank[where[hit]]
    return out


def contexts(ids: np.ndarray, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """places x sides: what stands around, EDGE beyond the text."""
    text = np.searchsorted(rows, places, "right") - 1
    at = places[:, None] + np.array(SIDES)
    inside = (at >= rows[text][:, None]) & (at < rows[text + 1][:, None])
    return np.where(inside, ids[np.clip(at, 0, max(len(ids) - 1, 0))], EDGE)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def _forward(net, around):
    seen = net["embed"][around].reshape(len(around), -1)
    hidden = np.tanh(seen @ net["inner"] + net["bias"])
    return seen, hidden, _log_softmax(hidden @ net["group"] + net["group_bias"])


def _by_class(group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of rows by class, and of each class that occurs its rows in it."""
    order, ends = np.argsort(group.astype(np.int16), kind="stable"), np.cumsum(np.bincount(group, minlength=CLASSES)).tolist()
    return order, [(c, slice(a, b)) for c, (a, b) in enumerate(zip([0, *ends], ends, strict=False)) if a < b]


def _inside_class(net, rows: np.ndarray, classes: list[tuple[int, slice]]) -> np.ndarray:
    """Log-probabilities of the terms of each row's class; rows are in order of classes."""
    out = np.empty((len(rows), CLASSES), rows.dtype)
    for c, part in classes:
        np.matmul(rows[part], net["term"][c], out=out[part])
        out[part] += net["term_bias"][c]
    return _log_softmax(out)


def log_probabilities(net: dict[str, np.ndarray], around: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """log P(term | both sides) of each place."""
    _, hidden, groups = _forward(net, around)
    group, term = ids // CLASSES, ids % CLASSES
    out = groups[np.arange(len(ids)), group]
    order, classes = _by_class(group)
    out[order] += _inside_class(net, hidden[order], classes)[np.arange(len(ids)), term[order]]
    return out


def gradients(net: dict[str, np.ndarray], around: np.ndarray, ids: np.ndarray) -> dict[str, np.ndarray]:
    """Slopes of the mean log-probability of a batch."""
    seen, hidden, groups = _forward(net, around)
    n = len(ids)
    out = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    group, term = ids // CLASSES, ids % CLASSES
    d = -np.exp(groups)
    d[np.arange(n), group] += 1
    back = d @ net["group"].T
    out["group"], out["group_bias"] = hidden.T @ d, d.sum(0)
    order, classes = _by_class(group)
    rows = hidden[order]
    d = -np.exp(_inside_class(net, rows, classes))
    d[np.arange(n), term[order]] += 1
    inner = np.empty_like(rows)
    for c, part in classes:
        np.matmul(d[part], net["term"][c].T, out=inner[part])
        out["term"][c], out["term_bias"][c] = rows[part].T @ d[part], d[part].sum(0)
    back[order] += inner
    back *= 1 - hidden**2
    out["inner"], out["bias"] = seen.T @ back, back.sum(0)
    slopes = np.ascontiguousarray((back @ net["inner"].T).reshape(n * len(SIDES), WIDTH).T)
    out["embed"] = np.stack([np.bincount(around.ravel(), x, SIZE + 1) for x in slopes], 1).astype(np.float32)
    return {k: x / n for k, x in out.items()}


def train_step(net: dict[str, np.ndarray], past: dict[str, np.ndarray], around: np.ndarray, ids: np.ndarray, rate: float) -> None:
    """One adaptive step uphill, in place; past holds the sums of squared slopes."""
    for k, g in gradients(net, around, ids).items():
        past[k] += g * g
        net[k] += rate * g / np.sqrt(past[k])


def masked_places(terms: np.ndarray, rows: np.ndarray, number: int, rounds: int, masked: float) -> np.ndarray:
    """The places of round `number`: a share of `masked`, or more where the rounds wouldn't cover all places otherwise."""
    width = min(max(int(masked * 2**64), -(-(2**64) // rounds)), 2**64)
    inside = np.arange(len(terms), dtype=np.uint64) - np.repeat(rows[:-1], np.diff(rows)).astype(np.uint64)
    return np.flatnonzero(mix(terms + inside, 70) - np.uint64(number * width % 2**64) <= np.uint64(width - 1))


def train(docs: DataFrame, words: np.ndarray, rounds: int = 2, masked: float = 0.15, rate: float = 0.1) -> dict[str, np.ndarray]:
    """The network after `rounds` passes over all texts; words as vocabulary() gives them."""
    order = np.argsort(words)
    sc = docs.sparkSession.sparkContext
    values = flat(first_network())
    for number in range(rounds):
        shared = sc.broadcast((words[order], order, values))

        def run(batches, shared=shared, number=number):
            known, rank, start = shared.value
            net, places_seen, kept = unflat(start), 0, []
            past = {k: np.full(s, 1e-8, np.float32) for k, s in SHAPES.items()}
            for batch in batches:
                for _, _, rows, terms in _texts(batch.column(0)):
                    if not len(terms):
                        continue
                    ids = numbered(terms, known, rank)
                    places = masked_places(terms, rows, number, rounds, masked)
                    kept.append((contexts(ids, rows, places), ids[places]))
                    around, targets = (np.concatenate(x) for x in zip(*kept, strict=True))
                    done = len(targets) // STEP * STEP
                    for lo in range(0, done, STEP):
                        train_step(net, past, around[lo : lo + STEP], targets[lo : lo + STEP], rate / (1 + number))
                    places_seen += done
                    kept = [(around[done:], targets[done:])]
            if kept and len(kept[0][1]):
                train_step(net, past, *kept[0], rate / (1 + number))
                places_seen += len(kept[0][1])
            if places_seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(start), dtype=np.int32)), pa.array(flat(net).astype(np.float64) * places_seen), pa.array(np.full(len(start), float(places_seen)))], ["k", "x", "w"])

        found = docs.select("text").mapInArrow(run, "k int, x double, w double").groupBy("k").agg((F.sum("x") / F.sum("w")).alias("x")).toPandas()
        if len(found):
            values = found.sort_values("k")["x"].to_numpy(np.float64)
    return unflat(values)


def shares(counts: DataFrame, words: np.ndarray):
    """What scoring knows of terms inside shared outputs: hashes (sorted) and log counts of the commonest, TABLE at most;
    each shared output's log of all counts and one; and term, log_n of the terms that found no room, those that occur once
    left out (their log count is 0)."""
    spark = counts.sparkSession
    own = spark.createDataFrame([(int(w),) for w in words.view(np.int64)], "term long")
    rest = counts.join(F.broadcast(own), "term", "left_anti")
    totals = np.ones(OTHERS)
    for r in rest.groupBy((F.shiftrightunsigned("term", 32) % OTHERS).alias("output")).agg(F.sum("n").alias("n")).collect():
        totals[r["output"]] += r["n"]
    rest = rest.where("n > 1")
    least, room = 2, TABLE
    for r in sorted(rest.groupBy("n").agg(F.count("*").alias("terms")).collect(), reverse=True):
        room -= r["terms"]
        if room < 0:
            least = r["n"] + 1
            break
    table = rest.where(F.col("n") >= least).toPandas()
    term = table["term"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(term)
    left = rest.where(F.col("n") < least).select("term", F.log(F.col("n").cast("double")).alias("log_n")) if least > 2 else None
    return term[order], np.log(table["n"].to_numpy(np.float64)[order]), np.log(totals), left


def score(docs: DataFrame, words: np.ndarray, net: dict[str, np.ndarray], counts: DataFrame | None = None) -> DataFrame:
    """doc_id, n_terms, log_likelihood (summed over the text's terms), mean of every row; counts as term_counts() gives
    them, of docs themselves where none are given."""
    table, log_n, log_totals, left = shares(term_counts(docs) if counts is None else counts, words)
    order = np.argsort(words)
    shared = docs.sparkSession.sparkContext.broadcast((words[order], order, flat(net), table, log_n, log_totals))
    keep = left is not None

    def run(batches):
        known, rank, values, table, log_n, log_totals = shared.value
        trained = unflat(values)
        for batch in batches:
            for lo, hi, rows, terms in _texts(batch.column(1)):
                ids = numbered(terms, known, rank)
                found = np.zeros(len(ids) + 1)
                for a in range(0, len(ids), BATCH):
                    places = np.arange(a, min(a + BATCH, len(ids)))
                    found[a + 1 : a + 1 + len(places)] = log_probabilities(trained, contexts(ids, rows, places), ids[places])
                rest = np.flatnonzero(ids >= VOCABULARY)
                found[rest + 1] -= log_totals[ids[rest] - VOCABULARY]
                if len(table):
                    where = np.minimum(np.searchsorted(table, terms[rest]), len(table) - 1)
                    hit = table[where] == terms[rest]
                    found[rest[hit] + 1] += log_n[where[hit]]
                    rest = rest[~hit]
                rest = rest if keep else rest[:0]
                sums, n = np.cumsum(found), np.diff(rows)
                total = sums[rows[1:]] - sums[rows[:-1]]
                unknown = pa.ListArray.from_arrays(np.searchsorted(rest, rows).astype(np.int32), terms[rest].view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(total), batch.column(2).slice(lo, hi - lo), unknown], ["doc_id", "n_terms", "x", "row", "unknown"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row")).mapInArrow(run, "doc_id long, n_terms long, x double, row long, unknown array<long>")
    if keep:
        found = materialise(found)
        more = found.select("row", F.explode("unknown").alias("term")).join(left, "term").groupBy("row").agg(F.sum("log_n").alias("more"))
        found = found.drop("unknown").join(more, "row", "left").withColumn("x", F.col("x") + F.coalesce("more", F.lit(0.0)))
    return found.select("doc_id", "n_terms", F.col("x").alias("log_likelihood"), (F.col("x") / F.greatest("n_terms", F.lit(1))).alias("mean"))
