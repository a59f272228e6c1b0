"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit distance.

Texts and items are sequences of terms (runs of letters, digits and characters beyond ASCII, A-Z lower-cased). The CGK
random walk reads a window from left to right; at each step it emits the term it stands on, and a random bit of (step,
term) says whether it goes on to the next. Sequences of small edit distance so become rows of small Hamming distance.
A table hashes a few sampled steps of the walk; an item is in every table, so a window that agrees with it on the steps
of any one is a candidate. The number of tables follows from the recall aimed at, which edits near an item's beginning or
of a fifth of its terms fall short of; so each item is also cut into one part more than it may have edits, one of which
at least is unedited in every leak, and texts that hold a part as it stands are candidates too: no leak is missed,
whatever the tables find. The edit distance of the item to the
best place around each candidate is then computed exactly, in terms; up to `most_edits` of the item's length is a leak.

Windows begin at every STRIDE-th term of a text, and items are entered once for each of the STRIDE first terms left
out, so that a passage is met at any offset. Items of fewer than LEAST_TERMS terms have to occur unchanged. Items are
searched in blocks of `block_items`, each broadcast to one scan of all texts.

Null and empty texts and items match nothing. Pairs are unique also where rows repeat; pairs with a null doc_id or
item_id are kept as such. Of places with equally few edits the first is told. Texts and items may be of any length. Other
columns are not read, whatever their names; an empty table on either side gives an empty result.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figloom.llm.textblocks import LOWER, NOT_TERM, mix, ngram_hashes, text_blocks, word_hashes, word_spans

STRIDE = 4
LEAST_TERMS = 8
#: Lengths of walks that tables sample from; an item uses all that it is sure to fill: the shorter meet fewer edits.
WALKS = (16, 24, 36, 54)
SAMPLED = 5
#: Keys of fewer different terms than this would be met everywhere; such items are searched by their parts.
LEAST_DIFFERENT = 4
_FILTER = np.uint64((1 << 22) - 1)
_PAIR = "doc_id long, item_id long, edits int, item_terms int, start int"


@dataclass
class Index:
    """Items of one block: their terms, and the sorted keys of all tables with the items and offsets behind them; parts has
    the same (keys, items, offsets, maybe) for each length of parts."""

    ids: list
    terms: list
    edits: list
    tables: list
    keys: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    maybe: np.ndarray
    short: dict
    parts: dict


def tables_needed(recall: float, agree: float) -> int:
    """Tables of SAMPLED steps each, so that a pair that agrees on each step with probability `agree` is met by one."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agree**SAMPLED))


def walk(terms: np.ndarray, starts: np.ndarray, steps: int, last: np.ndarray | None = None) -> np.ndarray:
    """steps x len(starts): what the walks from `starts` emit; walks stop at `last`, the last term of all if not given."""
    out = np.empty((steps, len(starts)), np.uint64)
    at, last = starts.copy(), len(terms) - 1 if last is None else last
    for t in range(steps):
        if t % 64 == 0:
            coins = mix(terms, 60 + t // 64)
        np.take(terms, at, out=out[t])
        at += ((coins[at] >> np.uint64(t % 64)) & np.uint64(1)).astype(at.dtype)
        np.minimum(at, last, out=at)
    return out


def _key(emitted: np.ndarray, table: int, steps: np.ndarray) -> np.ndarray:
    key = np.full(emitted.shape[1], table + 1, np.uint64)
    for t in steps:
        key = (key ^ emitted[t]) * np.uint64(0x9FB21C651E98DF25)
        key ^= key >> np.uint64(29)
    return key


def terms_of(data: np.ndarray, offsets: np.ndarray):
    data = LOWER[data]
    starts, stops, rows = word_spans(data, offsets, NOT_TERM)
    return word_hashes(data, starts, stops), rows


def parts_of(words: np.ndarray, edits: int) -> list[tuple[int, int]]:
    """(offset, length) of edits + 1 parts of an item; any `edits` edits leave one of them whole."""
    cuts = [i * len(words) // (edits + 1) for i in range(edits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]


def _sorted_keys(keys: list, item: list, offset: list):
    """The keys in order, with the items and offsets behind them; each list holds arrays."""
    keys, item, offset = (np.concatenate([np.zeros(0, kind), *x]) for x, kind in ((keys, np.uint64), (item, np.int64), (offset, np.int64)))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    maybe = np.zeros(int(_FILTER) + 1, bool)
    maybe[(keys & _FILTER).astype(np.int64)] = True
    return keys, item[order], offset[order], maybe


def _lookup(found: np.ndarray, keys: np.ndarray, maybe: np.ndarray):
    """(place in found, place in keys) of all that are equal."""
    hit = np.flatnonzero(maybe[(found & _FILTER).astype(np.int64)])
    left = np.searchsorted(keys, found[hit])
    n = np.searchsorted(keys, found[hit], "right") - left
    return np.repeat(hit, n), np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def build_index(items: list[tuple[int, str]], most_edits: float, recall: float, agree: float) -> Index:
    """The index of one block: all its items are walked, keyed and cut side by side."""
    rng = np.random.default_rng(20170)
    count = tables_needed(recall, agree)
    tables = [(w, np.sort(rng.choice(w, SAMPLED, replace=False))) for w in WALKS for _ in range(count)]
    raw = [(i, (text or "").encode()) for i, text in items]
    data = np.frombuffer(b"".join(x for _, x in raw), np.uint8)
    words, rows = terms_of(data, np.concatenate([[0], np.cumsum([len(x) for _, x in raw], dtype=np.int64)]))
    own = [(raw[k][0], words[rows[k] : rows[k + 1]]) for k in np.flatnonzero(np.diff(rows)).tolist()]
    ids, terms = [i for i, _ in own], [x for _, x in own]
    sizes = np.array([len(x) for x in terms], np.int64)
    edits = np.where(sizes < LEAST_TERMS, 0, (most_edits * sizes).astype(np.int64)).tolist()
    short: dict = {}
    parts: dict = {}
    for k, x in enumerate(terms):
        for o, n in parts_of(x, edits[k]) if len(x) >= LEAST_TERMS else [(0, len(x))]:
            into = parts if len(x) >= LEAST_TERMS else short
            into.setdefault(n, ([], [], []))
            for to, v in zip(into[n], (x[o : o + n], k, o), strict=True):
                to.append(v)

    def hashed(n, pieces):
        return ngram_hashes(np.concatenate(pieces), np.arange(len(pieces) + 1) * n, n)[0]

    found: dict = {}
    for n, (pieces, of, _) in short.items():
        for h, k in zip(hashed(n, pieces).tolist(), of, strict=True):
            found.setdefault(n, {}).setdefault(h, []).append(k)
    keys, item, offset = [], [], []
    long = np.flatnonzero(sizes >= LEAST_TERMS)
    if len(long):
        # Each item's terms are followed by a 0, where its walks stop.
        line = np.concatenate([y for k in long.tolist() for y in (terms[k], np.zeros(1, np.uint64))])
        last = np.cumsum(sizes[long] + 1) - 1
        first = np.repeat(last - sizes[long], STRIDE) + np.tile(np.arange(STRIDE), len(long))
        emitted = walk(line, first, WALKS[-1], np.repeat(last, STRIDE))
        inside = np.where((emitted == 0).any(0), (emitted == 0).argmax(0), WALKS[-1])
        for number, (w, steps) in enumerate(tables):
            sampled = np.sort(emitted[steps], axis=0)
            go = np.flatnonzero((w <= inside) & ((np.diff(sampled, axis=0) != 0).sum(0) + 1 >= LEAST_DIFFERENT))
            keys.append(_key(emitted[:, go], number, steps))
            item.append(long[go // STRIDE])
            offset.append(go % STRIDE)
    keys, item, offset, maybe = _sorted_keys(keys, item, offset)
    cut = {n: _sorted_keys([hashed(n, x)], [np.array(of, np.int64)], [np.array(o, np.int64)]) for n, (x, of, o) in parts.items()}
    return Index(ids, terms, edits, [(n, w, s) for n, (w, s) in enumerate(tables)], keys, item, offset, maybe, found, cut)


def best_place(pattern: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Least edit distance of the pattern to any part of each row of texts (0 marks no term), and where that part ends."""
    n, width = texts.shape
    column = np.arange(width + 1)
    row = np.zeros((n, width + 1), np.int64)
    for i, term in enumerate(pattern, 1):
        now = np.empty_like(row)
        now[:, 0] = i
        np.minimum(row[:, :-1] + (texts != term), row[:, 1:] + 1, out=now[:, 1:])
        row = np.minimum.accumulate(now - column, axis=1) + column
    return row.min(1), row.argmin(1)


def search(terms: np.ndarray, rows: np.ndarray, index: Index):
    """(text, item, edits, first term) of every leak found in the texts of a block; the best of each text and item."""
    found: dict[tuple[int, int], tuple[int, int]] = {}
    if not len(terms):
        return found
    count = -(-np.diff(rows) // STRIDE)
    text = np.repeat(np.arange(len(count)), count)
    starts = rows[text] + STRIDE * (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count))
    candidates = []
    longest = max((w for _, w, _ in index.tables), default=0)
    for lo in range(0, len(starts) if len(index.keys) else 0, 1 << 14):
        some = starts[lo : lo + (1 << 14)]
        emitted = walk(terms, some, longest)
        for number, _, steps in index.tables:
            key = _key(emitted, number, steps)
            w, which = _lookup(key, index.keys, index.maybe)
            if len(w):
                candidates.append(np.stack([text[lo + w], index.item[which], some[w] - index.offset[which]], 1))
    for length, (keys, item, offset, maybe) in index.parts.items():
        grams, at = ngram_hashes(terms, rows, length)
        p, which = _lookup(grams, keys, maybe)
        if len(p):
            t = np.searchsorted(at, p, "right") - 1
            first = rows[t] + p - at[t] - offset[which]
            # Places are read from STRIDE terms before to STRIDE after, so one of STRIDE neighbours is enough.
            candidates.append(_unique(np.stack([t, item[which], first // STRIDE * STRIDE], 1)))
    if candidates:
        for k, group in _by_item(_unique(np.concatenate(candidates))):
            pattern, most = index.terms[k], index.edits[k]
            known = np.unique(pattern)
            span = len(pattern) + 2 * (most + STRIDE)
            for lo in range(0, len(group), max(1, (1 << 20) // span)):
                part = group[lo : lo + max(1, (1 << 20) // span)]
                first = np.maximum(part[:, 2] - most - STRIDE, rows[part[:, 0]])
                at = first[:, None] + np.arange(span)
                places = np.where(at < rows[part[:, 0] + 1][:, None], terms[np.minimum(at, len(terms) - 1)], np.uint64(0))
                # At least len(pattern) - most terms of a leak stand in the item as well.
                near = np.minimum(np.searchsorted(known, places), len(known) - 1)
                enough = (known[near] == places).sum(1) >= len(pattern) - most
                if not enough.any():
                    continue
                part, first = part[enough], first[enough]
                distance, end = best_place(pattern, places[enough])
                for t, d, s in zip(part[:, 0].tolist(), distance.tolist(), (first + end - len(pattern) - rows[part[:, 0]]).tolist(), strict=True):
                    if d <= most and (d, s) < found.get((t, k), (1 << 60, 0)):
                        found[(t, k)] = (d, max(s, 0))
    for length, known in index.short.items():
        grams, at = ngram_hashes(terms, rows, length)
        for p in np.flatnonzero(np.isin(grams, np.array(list(known), np.uint64))).tolist():
            t = int(np.searchsorted(at, p, "right")) - 1
            for k in known[int(grams[p])]:
                found.setdefault((t, k), (0, p - int(at[t])))
    return found


def _unique(candidates: np.ndarray) -> np.ndarray:
    """The different rows of (text, item, first term)."""
    candidates = candidates[np.lexsort((candidates[:, 2], candidates[:, 0], candidates[:, 1]))]
    new = np.ones(len(candidates), bool)
    new[1:] = (candidates[1:] != candidates[:-1]).any(1)
    return candidates[new]


def _by_item(candidates: np.ndarray):
    """(item, its rows) of rows in order of items."""
    cuts = np.flatnonzero(np.diff(candidates[:, 1], prepend=-1))
    return [(int(candidates[c, 1]), g) for c, g in zip(cuts, np.split(candidates, cuts[1:]), strict=True)] if len(candidates) else []


def leaks(docs: DataFrame, items: DataFrame, most_edits: float = 0.2, recall: float = 0.985, agree: float = 0.75, block_items: int = 20_000) -> DataFrame:
    """doc_id, item_id, edits, item_terms, start (term of the text) of every pair of a text and an item that it holds.

    recall is aimed at by the tables for pairs whose embeddings agree on a share `agree` of the steps; the parts find all."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    blocks = -(-items.count() // block_items)
    out = None
    for b in range(blocks):
        some = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        shared = spark.sparkContext.broadcast(build_index([tuple(r) for r in some.collect()], most_edits, recall, agree))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                for lo, _, data, offsets in text_blocks(batch.column(1)):
                    found = search(*terms_of(data, offsets), index)
                    if found:
                        t, k = zip(*found, strict=True)
                        d, s = zip(*found.values(), strict=True)
                        ids = batch.column(0).take(pa.array([lo + x for x in t]))
                        yield pa.RecordBatch.from_arrays([ids, pa.array([index.ids[x] for x in k], pa.int64()), pa.array(d, pa.int32()), pa.array([len(index.terms[x]) for x in k], pa.int32()), pa.array(s, pa.int32())], [c.split()[0] for c in _PAIR.split(", ")])

        found = texts.mapInArrow(run, _PAIR)
        out = found if out is None else out.union(found)
    # An empty table of Python rows beside the others would hold workers of its own.
    out = spark.createDataFrame([], _PAIR) if out is None else out
    return out.groupBy("doc_id", "item_id").agg(F.min(F.struct("edits", "item_terms", "start")).alias("b")).select("doc_id", "item_id", "b.*")
