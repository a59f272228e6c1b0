"""Substring dedup over super-k-mers.

A window is `width` consecutive words of one text. Its minimiser is the least hash of its m-grams of words, leftmost
of equals. Consecutive windows with one minimiser make a super-k-mer, which travels as one packed string of word codes
to its minimiser's bucket; there all windows are sorted by hash, told apart by their codes, and counted.

What need not travel stays: windows whose minimiser occurs once in the corpus (told by a Bloom filter of fixed size
over the repeated ones, exact counts behind it), and windows that a chunk of texts holds twice, which are repeated by
that; of these one travels for the chunk. So a passage that a third of all texts share reaches its bucket once for
each chunk. Minimisers that occur very often rank last, so that what stands around such a passage goes elsewhere; windows
that have no other are dealt by a second minimiser, of another order of m-grams, too. A bucket is counted as it comes:
beyond BUCKET_BYTES, of what has come each different window is kept once.

Null texts have no words. A row whose doc_id and text both recur is a copy of its twin: all its windows are repeated.
Texts shorter than a window lose nothing, and texts may be of any length; null ids are kept; windows are judged on the
input, not on what is left; other columns are not read, whatever their names; an empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figloom.functions.session import materialise
from figloom.llm import bloom
from figloom.llm.textblocks import _power_tables, mix, text_blocks, word_hashes, word_spans

MGRAM = 6
#: Texts of this many bytes are looked at together.
CHUNK_BYTES = 2 << 20
#: Packed bytes of one bucket that are counted together.
BUCKET_BYTES = 16 << 20
#: Bytes of a word's code in a packed string.
CODE = 6
_PLACE = np.uint64(22)
_CODES = "doc_id long, h long, mini long, first int, windows int, weight int, packed binary"
_LATE = np.uint64(1 << 63)


def _chunks(batches, block_bytes: int = 1 << 20):
    """(doc ids, text hashes, word codes, where each text's words begin) of up to CHUNK_BYTES of texts."""
    for batch in batches:
        parts, size = [], 0
        for lo, hi, data, offsets in text_blocks(batch.column(2), block_bytes):
            starts, stops, rows = word_spans(data, offsets)
            parts.append((lo, hi, word_hashes(data, starts, stops) & np.uint64((1 << (8 * CODE)) - 1), np.diff(rows)))
            size += len(data)
            if size >= CHUNK_BYTES:
                yield _joined(batch, parts)
                parts, size = [], 0
        if parts:
            yield _joined(batch, parts)


def _joined(batch, parts):
    lo, hi = parts[0][0], parts[-1][1]
    counts = np.concatenate([p[3] for p in parts])
    return batch.slice(lo, hi - lo), np.concatenate([p[2] for p in parts]), np.concatenate([[0], np.cumsum(counts)])


def _window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every `width` words in a row."""
    power, inverse = _power_tables(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(words) * power[: len(words)], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * inverse[: len(words) - width + 1], 3)


def _minimisers(words: np.ndarray, width: int, late: np.ndarray, seed: int = 0) -> np.ndarray:
    """Of every window: the hash of its least m-gram, and below that (22 bits) the place of it."""
    m = min(MGRAM, width)
    grams = np.zeros(len(words) - m + 1, np.uint64)
    for k in range(m):
        grams = mix(grams + words[k : len(words) - m + 1 + k], seed + k)
    grams >>= np.uint64(1)
    if len(late):
        where = np.minimum(np.searchsorted(late, grams >> _PLACE), len(late) - 1)
        grams[late[where] == grams >> _PLACE] |= _LATE
    least = (grams >> _PLACE << _PLACE) | (np.arange(len(grams), dtype=np.uint64) & np.uint64((1 << 22) - 1))
    span, window = 1, width - m + 1
    while 2 * span <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[: len(grams) - window + 1], least[window - span :]) if span < window else least


def _windows(words: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """First words of the windows that lie in one text, and the text of each."""
    count = np.maximum(np.diff(rows) - width + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - (ends - count)[text] + rows[text], text


def _runs(*breaks: np.ndarray) -> np.ndarray:
    """Where a new run of equal values begins, and the end."""
    n = len(breaks[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for b in breaks:
        new[1:] |= b[1:] != b[:-1]
    return np.append(np.flatnonzero(new), n)


def _equal_windows(words: np.ndarray, at: np.ndarray, width: int, bucket: np.ndarray | None = None):
    """An order of the windows at `at`, and where runs of equal ones begin in it, and the end. Windows of one hash are
    compared word by word; where these differ, they are sorted by their words."""
    hashes = _window_hashes(words, width)[at]
    order = np.argsort(hashes, kind="stable") if bucket is None else np.lexsort((hashes, bucket))
    cuts = _runs(hashes[order]) if bucket is None else _runs(bucket[order], hashes[order])
    begins = np.zeros(len(at) + 1, bool)
    begins[cuts] = True
    pairs = np.flatnonzero(~begins[1:-1]) + 1
    differ = np.zeros(len(pairs), bool)
    for lo in range(0, len(pairs), 1 << 16):
        a, b = at[order[pairs[lo : lo + (1 << 16)] - 1]], at[order[pairs[lo : lo + (1 << 16)]]]
        for k in range(width):
            differ[lo : lo + (1 << 16)] |= words[a + k] != words[b + k]
    for run in np.unique(np.searchsorted(cuts, pairs[differ], "right") - 1).tolist():
        span = slice(cuts[run], cuts[run + 1])
        _, of = np.unique(words[at[order[span]][:, None] + np.arange(width)], axis=0, return_inverse=True)
        of = of.ravel()
        mixed = np.argsort(of, kind="stable")
        order[span] = order[span][mixed]
        begins[span.start + 1 : span.stop] = np.diff(of[mixed]) != 0
    return order, np.flatnonzero(begins)


def repeated_minimisers(docs: DataFrame, width: int) -> DataFrame:
    """mini, n: minimisers that occur twice or more in the corpus; counted in every chunk before the shuffle."""

    def run(batches):
        for _, words, rows in _chunks(batches):
            at, _ = _windows(words, rows, width)
            if len(at):
                both = _minimisers(words, width, np.zeros(0, np.uint64))[at]
                places = both[_runs(both)[:-1]] >> _PLACE
                mini, n = np.unique(places, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(mini.view(np.int64)), pa.array(n)], ["mini", "n"])

    return docs.mapInArrow(run, "mini long, n long").groupBy("mini").agg(F.sum("n").alias("n")).where("n > 1")


def _rows(part, text, mini, first, windows, weight, packed):
    ids, h = part.column(0).take(pa.array(text)), part.column(1).take(pa.array(text))
    return pa.RecordBatch.from_arrays([ids, h, pa.array(mini.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(np.broadcast_to(np.int32(weight), len(text)) if np.isscalar(weight) else weight.astype(np.int32)), packed], [c.split()[0] for c in _CODES.split(", ")])


def _pack(words: np.ndarray, first: np.ndarray, length: np.ndarray) -> pa.Array:
    ends = np.cumsum(length)
    index = np.arange(ends[-1]) - np.repeat(ends - length - first, length)
    data = np.ascontiguousarray(words[index].view(np.uint8).reshape(-1, 8)[:, :CODE])
    offsets = np.concatenate([[0], ends * CODE]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


def super_kmers(docs: DataFrame, width: int, words_of_filter: np.ndarray, late: np.ndarray) -> DataFrame:
    """Rows that travel: packed windows (weight 1, or 2 if the chunk holds them twice); weight 0: runs known to be repeated."""
    shared = docs.sparkSession.sparkContext.broadcast((words_of_filter, np.sort(late)))

    def run(batches):
        table, last = shared.value
        for part, words, rows in _chunks(batches):
            at, text = _windows(words, rows, width)
            if not len(at):
                continue
            plain = _minimisers(words, width, np.zeros(0, np.uint64))[at] >> _PLACE
            cuts = _runs(plain)
            may = np.repeat(bloom.may_hold(table, mix(plain[cuts[:-1]], 9)), np.diff(cuts))
            at, text = at[may], text[may]
            if not len(at):
                continue
            mini = _minimisers(words, width, last)[at]
            key, second = mini >> _PLACE, np.zeros(len(at), np.uint64)
            hot = mini >= _LATE
            if hot.any():
                second[hot] = _minimisers(words, width, np.zeros(0, np.uint64), 50)[at[hot]]
                key[hot] = mix(key[hot] ^ mix(second[hot] >> _PLACE, 4), 5) >> _PLACE
            order, cuts = _equal_windows(words, at, width)
            twice, later = np.zeros(len(at), bool), np.ones(len(at), bool)
            twice[order] = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
            later[order[cuts[:-1]]] = False
            known = np.flatnonzero(twice)
            if len(known):
                cuts = _runs(at[known] - np.arange(len(known)), text[known])
                a = known[cuts[:-1]]
                yield _rows(part, text[a], mix(at[a].astype(np.uint64) + text[a].astype(np.uint64)), at[a] - rows[text[a]], np.diff(cuts), 0, pa.nulls(len(a), pa.binary()))
            go = np.flatnonzero(~later)
            cuts = _runs(at[go] - np.arange(len(go)), text[go], mini[go], second[go], twice[go])
            a, n = go[cuts[:-1]], np.diff(cuts)
            for lo in range(0, len(a), 20_000):
                b, k = a[lo : lo + 20_000], n[lo : lo + 20_000]
                yield _rows(part, text[b], key[b], at[b] - rows[text[b]], k, 1 + twice[b], _pack(words, at[b], k + width - 1))

    return docs.mapInArrow(run, _CODES)


def count_windows(travelled: DataFrame, width: int, partitions: int | None = None) -> DataFrame:
    """doc_id, h, first, windows: runs of windows that the corpus holds twice or more; a bucket lies in one partition."""

    names = ["doc_id", "h", "first", "windows"]

    def counted(batch, closed=True):
        """Runs of windows known to be repeated by now; where more of the bucket is to come, also what has to be kept."""
        weight = batch.column(5).to_numpy()
        known, sent = np.flatnonzero(weight == 0), np.flatnonzero(weight)
        out, kept = [(known, batch.column(3).to_numpy()[known], batch.column(4).to_numpy()[known])], []
        if len(sent):
            part = batch.take(pa.array(sent))
            data = b"".join(part.column(6).to_pylist())
            codes = np.zeros((len(data) // CODE, 8), np.uint8)
            codes[:, :CODE] = np.frombuffer(data, np.uint8).reshape(-1, CODE)
            words = codes.view(np.uint64).ravel()
            first, windows = part.column(3).to_numpy(), part.column(4).to_numpy().astype(np.int64)
            rows = np.concatenate([[0], np.cumsum(windows + width - 1)])
            at, row = _windows(words, rows, width)
            order, cuts = _equal_windows(words, at, width, part.column(2).to_numpy()[row])
            total = np.add.reduceat(weight[sent][row][order], cuts[:-1])
            repeated = np.zeros(len(at), bool)
            repeated[order] = np.repeat(total > 1, np.diff(cuts))
            hit = np.flatnonzero(repeated & (weight[sent][row] == 1))
            if len(hit):
                runs = _runs(at[hit] - np.arange(len(hit)), row[hit])
                a = hit[runs[:-1]]
                out.append((sent[row[a]], first[row[a]] + at[a] - rows[row[a]], np.diff(runs)))
            if not closed:
                stays = np.sort(order[cuts[:-1]])
                runs = _runs(at[stays] - np.arange(len(stays)), row[stays], repeated[stays])
                a, n = stays[runs[:-1]], np.diff(runs)
                kept.append(_rows(part, row[a], part.column(2).to_numpy().view(np.uint64)[row[a]], first[row[a]] + at[a] - rows[row[a]], n, 1 + repeated[a], _pack(words, at[a], n + width - 1)))
        which, first, n = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which)), batch.column(1).take(pa.array(which)), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))], names), kept

    def run(batches):
        """Rows come sorted by bucket; those of a batch's last bucket wait for the next batch."""
        waiting: list = []
        most = BUCKET_BYTES
        for batch in batches:
            mini = batch.column(2).to_numpy()
            if not len(mini):
                continue
            cut = int(np.searchsorted(mini, mini[-1]))
            if waiting and (cut or waiting[0].column(2)[0].as_py() != mini[0]):
                for part in pa.Table.from_batches([*waiting, batch.slice(0, cut)]).combine_chunks().to_batches():
                    yield counted(part)[0]
                waiting, most = [], BUCKET_BYTES
            elif cut:
                yield counted(batch.slice(0, cut))[0]
            waiting.append(batch.slice(cut))
            if sum(b.nbytes for b in waiting) > most:
                (part,) = pa.Table.from_batches(waiting).combine_chunks().to_batches()
                found, waiting = counted(part, closed=False)
                most = BUCKET_BYTES + 2 * sum(b.nbytes for b in waiting)
                yield found
        if waiting:
            for part in pa.Table.from_batches(waiting).combine_chunks().to_batches():
                yield counted(part)[0]

    dealt = travelled.repartition(partitions, "mini") if partitions else travelled.repartition("mini")
    return dealt.sortWithinPartitions("mini").mapInArrow(run, "doc_id long, h long, first int, windows int")


def remove_repeats(docs: DataFrame, width: int = 35, carry: tuple[str, ...] = (), filter_bytes: int = 1 << 25, late_count: int = 1000, most_late: int = 1 << 16) -> DataFrame:
    """doc_id, the carried columns, kept (the words left, joined by one space), n_words, n_removed of every row of docs.

    filter_bytes bounds the Bloom filter; minimisers of late_count occurrences and more (most_late of them) rank last."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text", *(F.col(c).alias(f"_{c}") for c in carry))
    plain = keyed.select("doc_id", "h", "text")
    repeated = materialise(repeated_minimisers(plain, width))
    n = repeated.count()
    table = _filter(repeated, min(filter_bytes, max(4096, 4 << n.bit_length())))
    late = np.array([r["mini"] for r in repeated.where(F.col("n") >= late_count).orderBy(F.desc("n"), "mini").limit(most_late).collect()], np.int64).view(np.uint64)
    runs = count_windows(super_kmers(plain, width, table, late), width)
    cuts = runs.groupBy("doc_id", "h").agg(F.collect_list(F.struct("first", "windows")).alias("runs"))
    both = keyed.alias("d").join(cuts.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.h") == F.col("c.h")), "left")

    names = ["doc_id", *carry, "kept", "n_words", "n_removed"]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                kept, words_of, removed = [], [], []
                for text, cut in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    words = (text or "").encode().split()
                    words_of.append(len(words))
                    if cut:
                        step = np.zeros(len(words) + 1, np.int64)
                        np.add.at(step, [r["first"] for r in cut], 1)
                        np.add.at(step, [r["first"] + r["windows"] + width - 1 for r in cut], -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)]
                    removed.append(words_of[-1] - len(words))
                    kept.append(b" ".join(words).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[3:], pa.array(kept, pa.string()), pa.array(words_of, pa.int64()), pa.array(removed, pa.int64())], names)

    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return both.select("d.doc_id", "d.text", "c.runs", *(f"d._{c}" for c in carry)).mapInArrow(run, f"doc_id long{kinds}, kept string, n_words long, n_removed long")


def _filter(repeated: DataFrame, filter_bytes: int) -> np.ndarray:
    return bloom.build(repeated, F.col("mini"), filter_bytes, seed=9)
