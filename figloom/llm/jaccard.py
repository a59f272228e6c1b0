r"""N-gram Jaccard join with PartEnum signatures.

A text's set holds its distinct shingles of `words` words (runs of other characters than space and \t..\r, A-Z
lower-cased); fewer words make one shingle; none make an empty set, which is linked with nothing. Two sets link when
100 * intersection >= percent * union.

Sizes are cut into bands; a set takes part in its own band and, where a partner may be in it, the next. Linked sets of
a band differ in at most k shingles. A hash cuts the domain into parts, and each part into n2 sub-parts: with
floor(k / (k2 + 1)) + 1 + e parts, 1 + e of them at least hold at most k2 differences, and there n2 - k2 sub-parts are equal.
So for each part every subset of n2 - k2 of its sub-parts makes one signature, of the shingles in them. n2 and k2 (1 and 0,
3 and 1, or 4 and 2) are chosen for each band by a cost estimate: more subsets are more signatures, which hold more shingles
each and so meet fewer strangers. Subsets that are empty tell nothing: a set in which more than e parts have an empty subset
is cut anew by another hash, and after the last one its empty subsets are signatures, too. No link is lost.

Equal sets are one class from the start. Classes that share a signature are candidates (the rows are counted by
signature first; a Bloom filter of the shared ones then keeps the others from travelling). Signatures are stored and travel
as SIG bytes each, and are dealt to turns by their remainder: a turn's are counted, filtered and put into buckets, and go
before the next turn's shuffles, so the disk holds one turn's at a time. Shingles aren't stored for all classes, but made
again from the texts of those whose bitmaps leave them a pair, in turns, too. Each round compares the
classes of a bucket with one of them, its hub, and joins what links to components; most buckets then hold one component
and are done. In buckets where a class has few others to be compared with (SMALL_BUCKET), the pairs between components are
compared: bitmaps rule out most, as two sets differ in at least as many shingles as their bitmaps in bits, and the sets of
the rest are intersected.

The classes of larger buckets with one hub, up to some thousands (GROUP), are a group whose bitmaps one task compares, so that strangers
who meet in many buckets are told apart without their sets: first each class with one partner at most that its bitmap leaves,
then, between the components that come of it, all; a group that leaves few pairs is done, and these are intersected.

In what is larger yet or leaves many pairs (at first, in all buckets that have one hub), the shingles that most classes have or
lack against the hub make the consensus, and each class is known by its difference from that. Two classes differ by the sum of their differences less
twice what these share. So pairs that link without sharing anything link with the class next to the consensus, too, and
that star is all they need. What the star's component doesn't hold is apart. A pair with a class apart shares a number of
elements that follows from the sizes, so it meets in one of the rarest elements of both (a prefix): more of the class
apart's and few of the other's, or few of both where both are apart. Those are the buckets of the next round, and no element
is in the differences of more than half of a bucket's classes, so they halve each time and the rounds end by themselves.
Large groups of copies so take few comparisons a member, no large bucket's pairs are written out, and no link is lost.

Rows that repeat a doc_id are one document to the links. A null doc_id gets its class's component and names none.
Null and empty texts: n_shingles 0, component their own doc_id. Other columns are not read, whatever their names. Texts
may be of any length; an empty table gives an empty result.
"""

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from figloom.functions.session import append, discard, discard_part, materialise, materialise_by, release
from figloom.llm import bloom
from figloom.llm.components import components
from figloom.llm.textblocks import LOWER, mix, ngram_hashes, text_blocks, word_hashes, word_spans

HASHES = 3
#: Signatures that a task counts.
SIGNATURES = 2_000_000
#: Bytes of a signature as it is stored and travels. Equal ones stay equal; of billions, one in some hundred meets a stranger more.
SIG = 5
#: Signatures a row that are counted at a time, and turns at most (a power of two).
TURN, TURNS = 100, 4
#: Pieces that a task's signatures travel in, for each partition: many, so that partitions get alike.
PIECES = 8
#: Shingles of pairs that are intersected at a time, up to TURNS times.
ELEMENTS = 16_000_000
#: Pairs a class and bucket that are compared one by one.
SMALL_BUCKET = 8
#: Classes with one hub whose bitmaps are compared in one task: SMALL_BUCKET to this power, 4096.
GROUP = 4
#: Bits of a set's bitmap.
BITS = 2048
#: Rows, or elements of arrays, up to which a table of one row a hub is broadcast.
BROADCAST = 1_000_000


#: (n2, k2): sub-parts of a part, and how many of them may differ.
SHAPES = ((1, 0), (3, 1), (4, 2))
#: What a chance meeting costs, in signatures, and how much of a stranger's set is held in common.
MEETING, COMMON = 60, 0.5


class Bands:
    """Sizes of sets -> bands, and of each band the parts, their shape, and how many may have an empty subset."""

    def __init__(self, percent: int, growth: float | None = None):
        self.percent = percent
        # Narrow bands make k small, wide ones let fewer sets take part in two.
        self.growth = growth or min(((100 / percent) ** x for x in (1, 2)), key=self._cost_of)
        self.first, self.last, self.parts, self.shape, self.spare = [1], [], [], [], []
        self._add()

    def _cost_of(self, growth: float, size: int = 500) -> float:
        """Of a set of this size, anywhere in a band: its own band, and the next where a partner may be in it."""
        told = 0.0
        for x in np.linspace(0, 1, 11):
            lo = size / growth**x
            two = growth ** (1 - x) <= 100 / self.percent
            told += self._plan(int(lo), int(lo * growth))[0] + two * self._plan(int(lo * growth), int(lo * growth**2))[0]
        return told

    def _plan(self, lo: int, hi: int) -> tuple[float, int, int, int]:
        """Cost, parts, shape, spare parts for sets of lo to hi shingles."""
        k = 2 * hi * (100 - self.percent) // (100 + self.percent)
        plans = []
        for shape, (n2, k2) in enumerate(SHAPES if k > 2 else SHAPES[:1]):
            need, spare = k // (k2 + 1) + 1, 0
            for _ in range(8 if k else 0):
                # A part has an empty subset where n2 - k2 of its sub-parts are empty.
                none = np.exp(-max(1, lo * self.percent / 100) / ((need + spare) * n2))
                bad = (need + spare) * sum(comb(n2, j) * none**j * (1 - none) ** (n2 - j) for j in range(n2 - k2, n2 + 1))
                before, spare = spare, int(np.ceil(bad + 2 * np.sqrt(bad)))
                if spare == before or spare > 4 * need + 8:
                    break
            if spare <= 4 * need + 8 or not shape:
                parts = need + spare
                plans.append((parts * comb(n2, k2) * (1 + MEETING * COMMON ** (lo * (n2 - k2) / (parts * n2))), parts, shape, spare))
        return min(plans)

    def _add(self) -> None:
        lo = self.first[-1]
        hi = max(lo, int(lo * self.growth))
        _, parts, shape, spare = self._plan(lo, hi)
        self.last.append(hi)
        self.parts.append(parts)
        self.shape.append(shape)
        self.spare.append(spare)
        self.first.append(hi + 1)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while len(sizes) and self.last[-1] < 2 * sizes.max():
            self._add()
        return np.searchsorted(self.last, sizes)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int):
    """Distinct shingle hashes of each text, sorted, and where each text's begin."""
    data = LOWER[data]
    starts, stops, rows = word_spans(data, offsets)
    w = word_hashes(data, starts, stops)
    grams, at = ngram_hashes(w, rows, words)
    text = np.repeat(np.arange(len(rows) - 1), np.diff(at))
    short = np.flatnonzero((np.diff(rows) > 0) & (np.diff(rows) < words))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            more = rows[short] + k < rows[short + 1]
            whole[more] = mix(whole[more] + w[rows[short[more]] + k], 100 + k)
        grams, text = np.concatenate([grams, whole]), np.concatenate([text, short])
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    return grams[new], np.searchsorted(text[new], np.arange(len(rows)))


def _digests(sets: np.ndarray, at: np.ndarray):
    out = []
    for seed in (11, 12):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets, seed))])
        out.append(mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64), seed).view(np.int64))
    return out


def signatures(sets: np.ndarray, at: np.ndarray, bands: Bands):
    """(signature, set) of every set: see the module's text."""
    sizes = np.diff(at)
    band = bands.of(sizes)
    last = np.array(bands.last)
    which = np.flatnonzero(sizes > 0)
    up = which[sizes[which] * 100 // bands.percent > last[band[which]]]
    which, band = np.concatenate([which, up]), np.concatenate([band[which], band[up] + 1])
    shape = np.array(bands.shape)
    for seed in range(HASHES):
        again = []
        for kind, (n2, k2) in enumerate(SHAPES):
            mine = shape[band] == kind
            if mine.any():
                again.append((yield from _cut(sets, at, which[mine], band[mine], bands, seed, n2, k2)))
        which, band = (np.concatenate(x) for x in zip(*again, strict=True)) if again else (which[:0], band[:0])


def _cut(sets: np.ndarray, at: np.ndarray, which: np.ndarray, band: np.ndarray, bands: Bands, seed: int, n2: int, k2: int):
    """Yields (signature, set) of the sets `which` in their bands by one hash; returns those with too many empty subsets."""
    parts, n = np.array(bands.parts)[band], (at[1:] - at[:-1])[which]
    base = np.concatenate([[0], np.cumsum(parts * n2)])
    owner = np.repeat(np.arange(len(which)), n)
    ends = np.cumsum(n)
    values = sets[np.arange(ends[-1]) - np.repeat(ends - n - at[which], n)]
    cells = (parts * n2)[owner].astype(np.uint64)
    place = base[owner] + (((mix(values, 20 + seed) >> np.uint64(32)) * cells) >> np.uint64(32)).astype(np.int64)
    sums, full = np.zeros(base[-1], np.uint64), np.zeros(base[-1], bool)
    np.add.at(sums, place, mix(values, 30 + seed))
    full[place] = True
    sums, full = sums.reshape(-1, n2), full.reshape(-1, n2)
    part = np.repeat(np.arange(len(which)), parts)
    nth = np.arange(len(part)) - np.repeat(np.cumsum(parts) - parts, parts)
    empty = np.bincount(part[(~full).sum(1) >= n2 - k2], minlength=len(which))
    worse = empty > np.array(bands.spare)[band]
    for number, subset in enumerate(combinations(range(n2), n2 - k2)):
        content = np.zeros(len(part), np.uint64)
        for sub in subset:
            content = mix(content + sums[:, sub], 50)
        tag = (nth * 8 + number + 1_000_003 * (band[part] * HASHES + seed)).astype(np.uint64)
        go = full[:, list(subset)].any(1)
        if seed == HASHES - 1:
            go |= worse[part]
        yield mix(content[go] + mix(tag[go], 40), 41), which[part[go]]
    return which[worse], band[worse]


def _blocks(batches, words):
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(batch.num_columns - 1)):
            sets, at = shingle_sets(data, offsets, words)
            yield batch.slice(lo, hi - lo), sets, at, *_digests(sets, at)


def _pack(sig: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Pieces of an array of signatures, [ends[i], ends[i + 1]) each, as SIG bytes a signature."""
    data = np.ascontiguousarray(sig.view(np.uint8).reshape(-1, 8)[:, :SIG])
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * SIG).astype(np.int32)), pa.py_buffer(data)])


def _unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of a column of _pack, and where each row's begin (one number more than rows)."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    sig = np.zeros(((ends[-1] - ends[0]) // SIG, 8), np.uint8)
    if len(sig):
        sig[:, :SIG] = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, SIG)
    return sig.view(np.int64).ravel(), (ends - ends[0]) // SIG


def document_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n, d1, d2, sigs, turn: the size of each row's set, 128 bits that tell sets apart, and the set's signatures (those
    of equal sets of a block once) that leave the rest `turn` when divided by TURNS; turn 0 has all rows."""

    def run(batches):
        bands = Bands(percent)
        for part, sets, at, d1, d2 in _blocks(batches, words):
            _, once = np.unique(d1, return_index=True)
            mine = np.zeros(len(d1), bool)
            mine[once] = True
            found = [(sig[mine[which]], which[mine[which]]) for sig, which in signatures(sets, at, bands)] or [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
            sig, which = (np.concatenate(x) for x in zip(*found, strict=True))
            sig >>= np.uint64(64 - 8 * SIG)
            place = (sig % np.uint64(TURNS)).astype(np.int64) * len(d1) + which
            order = np.argsort(place, kind="stable")
            ends = np.searchsorted(place[order], np.arange(TURNS * len(d1) + 1))
            go = np.flatnonzero((np.diff(ends) > 0) | (np.arange(TURNS * len(d1)) < len(d1)))
            row, turn = pa.array(go % len(d1)), pa.array((go // len(d1)).astype(np.int32))
            columns = [c.take(row) for c in (part.column(0), pa.array(np.diff(at).astype(np.int64)), pa.array(d1), pa.array(d2))]
            yield pa.RecordBatch.from_arrays([*columns, _pack(sig[order], ends).take(pa.array(go)), turn], ["doc_id", "n", "d1", "d2", "sigs", "turn"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, d1 long, d2 long, sigs binary, turn int")


def _counted(old: tuple[np.ndarray, np.ndarray], sig: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different signatures and how often each occurs, with further ones."""
    every, place = np.unique(np.concatenate([old[0], sig]), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, place, np.concatenate([old[1], count]))
    return every, total


def _turn(whole: DataFrame, turn: int, turns: int) -> DataFrame:
    """The folders whose signatures leave the rest `turn` when divided by `turns`, which divides TURNS."""
    return whole.where(F.col("turn") % turns == turn)


def _recurring(whole: DataFrame, partitions: int, turn: int = 0, turns: int = 1) -> DataFrame:
    """sig: the signatures of a turn that occur on two rows or more.

    They are told once or twice a batch of rows before they travel, so one that most rows have is few; a task then holds the
    different signatures of its partition as plain numbers, some millions by the choice of partitions."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    pieces = partitions * PIECES
    # Where each piece of the range of signatures begins.
    edges = np.array([(k << 8 * SIG) // pieces for k in range(pieces + 1)], np.int64)

    def combined(batches):
        for batch in batches:
            sig, count = np.unique(_unpack(batch.column(0))[0], return_counts=True)
            sig = np.repeat(sig, np.minimum(count, 2))
            ends = np.searchsorted(sig, edges)
            go = np.flatnonzero(np.diff(ends))
            if len(go):
                yield pa.RecordBatch.from_arrays([pa.array(go.astype(np.int32)), _pack(sig, ends).take(pa.array(go))], ["piece", "sigs"])

    def summed(batches):
        held, waiting = none, []
        for batch in batches:
            sig = _unpack(batch.column(0))[0]
            waiting.append((sig, np.ones(len(sig), np.int64)))
            if sum(len(x) for x, _ in waiting) > max(len(held[0]) // 2, SIGNATURES // 4):
                held, waiting = _counted(held, *(np.concatenate(x) for x in zip(*waiting, strict=True))), []
        if waiting:
            held = _counted(held, *(np.concatenate(x) for x in zip(*waiting, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(held[0][held[1] > 1])], ["sig"])

    told = _turn(whole, turn, turns).select("sigs").mapInArrow(combined, "piece int, sigs binary")
    return told.repartition(partitions, "piece").select("sigs").mapInArrow(summed, "sig long")


def shared_signatures(whole: DataFrame, shared: DataFrame, filter_bytes: int) -> DataFrame:
    """sig, d1: the signatures of rows of whole that are in shared (written)."""
    table = whole.sparkSession.sparkContext.broadcast(bloom.build(shared, F.col("sig"), min(filter_bytes, max(4096, 4 << shared.count().bit_length())), seed=9))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                sig, ends = _unpack(batch.column(1).slice(lo, 512))
                keep = bloom.may_hold(table.value, mix(sig.view(np.uint64), 9))
                row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[keep]
                yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), batch.column(0).slice(lo, 512).take(pa.array(row))], ["sig", "d1"])

    return whole.select("d1", "sigs").mapInArrow(run, "sig long, d1 long").join(shared, "sig", "left_semi").distinct()


def _buckets(whole: DataFrame, rows: int, nodes: DataFrame, filter_bytes: int) -> DataFrame:
    """The unsettled buckets of all signatures, turn by turn; a turn's signatures go as soon as its buckets are written."""
    spark = whole.sparkSession
    total = whole.agg(F.coalesce(F.sum(F.octet_length("sigs")), F.lit(0))).first()[0] // SIG
    turns = min(TURNS, 1 << (max(1, -(-total // (TURN * max(1, rows)))) - 1).bit_length())
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (turns * SIGNATURES)))
    nodes = _few(nodes, nodes.count())
    out = None
    for turn in range(turns):
        shared = materialise(_recurring(whole, partitions, turn, turns))
        release(spark)
        members = materialise(shared_signatures(_turn(whole, turn, turns), shared, filter_bytes).join(nodes, "d1").select("sig", "node", "n").distinct())
        for k in range(turn, TURNS, turns):
            discard_part(whole, "turn", k)
        discard(shared)
        release(spark)
        found = _unsettled(members, None)
        out = materialise(found) if out is None else append(out, found)
        discard(members)
        release(spark)
    discard(whole)
    return out


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int, broadcast_ids: int, column: str) -> DataFrame:
    """node, n, and bitmap or shingles (arrays of longs) of the wanted nodes' texts; few ids are broadcast, else the texts are shuffled."""
    wanted = F.broadcast(wanted) if wanted.count() <= broadcast_ids else wanted

    def run(batches):
        for part, sets, at, _, _ in _blocks(batches, words):
            if column == "shingles":
                shingles = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(at).astype(np.int64)), shingles], ["node", "n", column])
                continue
            bits = np.zeros((len(at) - 1, BITS), bool)
            bits[np.repeat(np.arange(len(at) - 1), np.diff(at)), (mix(sets, 13) % np.uint64(BITS)).astype(np.int64)] = True
            packed = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
            bitmaps = pa.ListArray.from_arrays(pa.array(np.arange(0, packed.size + 1, BITS // 64, dtype=np.int32)), pa.array(packed.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(at).astype(np.int64)), bitmaps], ["node", "n", column])

    return docs.select("doc_id", "text").join(wanted.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").mapInArrow(run, f"node long, n long, {column} array<long>")


def _sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """pairs (u, v, ...; written or small) with n_u, s_u, n_v, s_v; where few nodes are asked for on a side, only their sets
    travel to it, and where all of one side's are small, they are broadcast: pairs have many u to a v, or few of both."""
    out = pairs
    for k in "uv":
        nodes = pairs.select(F.col(k).alias("node")).distinct()
        some, small = sets, False
        if nodes.count() <= BROADCAST:
            some = sets.join(F.broadcast(nodes), "node", "left_semi")
            elements = F.sum("n") if column == "shingles" else F.count("*") * (BITS // 64)
            small = k == "v" and (some.agg(elements).first()[0] or 0) <= BROADCAST
        some = some.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col(column).alias(f"s_{k}"))
        out = out.join(F.broadcast(some) if small else some, k)
    return out


def linked_pairs(pairs: DataFrame, bitmaps: DataFrame, shingles_of, percent: int) -> DataFrame:
    """u, v of the pairs that link: bitmaps first, then intersections of the sets that shingles_of (nodes) makes, in turns."""
    differ = F.aggregate(F.zip_with("s_u", "s_v", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    may = _sides(pairs, bitmaps, "bitmap").where((100 + percent) * differ <= (100 - percent) * (F.col("n_u") + F.col("n_v"))).select("u", "v", (F.col("n_u") + F.col("n_v")).alias("size"))
    may = materialise(may)
    elements = may.agg(F.sum("size")).first()[0] or 0
    turns = min(TURNS, -(-elements // ELEMENTS))
    out = None
    for turn in range(turns):
        # A hub's pairs fall into one turn, so that its set is made once.
        some = may.where(F.pmod(F.xxhash64("v"), F.lit(turns)) == turn).select("u", "v")
        release(pairs.sparkSession)
        sets = materialise(shingles_of(some.select(F.col("u").alias("node")).union(some.select("v")).distinct()))
        both = _sides(some, sets, "shingles").withColumn("i", F.size(F.array_intersect("s_u", "s_v")))
        found = both.where(100 * F.col("i") >= percent * (F.col("n_u") + F.col("n_v") - F.col("i"))).select("u", "v")
        out = materialise(found) if out is None else append(out, found)
        discard(sets)
    if out is None:
        return may.select("u", "v")
    discard(may)
    release(pairs.sparkSession)
    return out


def link(docs: DataFrame, words: int = 5, percent: int = 80, broadcast_ids: int = 1_000_000, filter_bytes: int = 1 << 24) -> DataFrame:
    """doc_id, n_shingles, class_id (least doc_id with an equal set), component_id (least doc_id reachable by links)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    whole = materialise_by(document_sets(docs, words, percent), "turn")
    sized = materialise(whole.where("turn = 0").drop("sigs", "turn"))
    classes = sized.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("node"))
    nodes = classes.select("d1", "node", "n").where("node is not null")
    comps = _component_of(docs, _buckets(whole, sized.count(), nodes, filter_bytes), words, percent, broadcast_ids)
    out = sized.join(classes.withColumnRenamed("node", "class_id"), ["n", "d1", "d2"], "left")
    out = out.join(comps.withColumnRenamed("node", "class_id"), "class_id", "left") if comps is not None else out.withColumn("comp", F.lit(None).cast("long"))
    own = F.when(F.col("n") == 0, F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(own, "class_id").alias("class_id"), F.coalesce(own, "comp", "class_id").alias("component_id"))


def _component_of(docs, buckets, words, percent, broadcast_ids):
    """node, comp of the classes that are linked to one of a lesser id; None where there are none. What is read for the last
    time goes at once, the first buckets, too."""
    comps, bitmaps, first = None, None, True

    def shingles_of(nodes):
        return _sets_of(docs, nodes, words, broadcast_ids, "shingles")

    while not buckets.isEmpty():
        if bitmaps is None:
            bitmaps = materialise(_sets_of(docs, buckets.select("node").distinct(), words, broadcast_ids, "bitmap"))
        spokes = materialise(buckets.where("node != hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct())
        comps = _joined(comps, linked_pairs(spokes, bitmaps, shingles_of, percent))
        left = materialise(_unsettled(buckets.select("sig", "node", "n"), comps))
        discard(buckets, spokes)
        release(docs.sparkSession)
        pairs = _pairs_within(left.where(F.col("node") != F.col("hub")).withColumn("pairs", F.col("size") - 1))
        large, apart, star, found = left.where(F.col("size") > 2 * SMALL_BUCKET), None, None, None
        if not large.isEmpty():
            chosen = materialise(_group_pairs(large, bitmaps, percent, one=True))
            comps = _joined(comps, linked_pairs(chosen.select("u", "v"), bitmaps, shingles_of, percent))
            apart = materialise(_unsettled(large.select("sig", "node", "n"), comps))
            found = materialise(_group_pairs(apart, bitmaps, percent, one=False))
            discard(chosen)
            pairs = pairs.union(found.where("u is not null").drop("hub"))
            large = apart.join(found.where("u is null").select("hub").distinct(), "hub", "left_semi")
        if large.isEmpty():
            buckets = large
        else:
            sets = materialise(shingles_of(large.select("node").union(large.select("hub")).distinct()))
            star = materialise(_star(large, sets))
            discard(sets)
            release(docs.sparkSession)
            near = _differences(_by_hub(star) if first else _by_bucket(large, star), percent)
            discard(star)
            release(docs.sparkSession)
            comps = _joined(comps, near.where("direct and u != hub").select("u", F.col("hub").alias("v")))
            fresh = _next_buckets(near, comps, percent)
            pairs = pairs.union(_pairs_within(fresh.where("not cross"))).union(_pairs_across(fresh.where("cross"))).distinct()
            buckets = fresh.where(F.col("pairs") > 2 * SMALL_BUCKET)
        pairs = materialise(pairs.where(f"least(n_u, n_v) * 100 >= {percent} * greatest(n_u, n_v)").select("u", "v"))
        comps = _joined(comps, linked_pairs(pairs, bitmaps, shingles_of, percent))
        buckets, first = materialise(_unsettled(buckets.select("sig", "node", "n"), comps)), False
        discard(left, apart, star, found, pairs)
        release(docs.sparkSession)
    discard(bitmaps)
    return comps


def _joined(comps: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """The components with further links."""
    links = materialise(links)
    if links.isEmpty():
        return comps
    return components(links if comps is None else links.union(comps.select("node", "comp")))


def _unsettled(buckets: DataFrame, comps: DataFrame | None) -> DataFrame:
    """sig, node, n, comp, size, hub (least node) of the buckets (sig, node, n) that hold several components."""
    buckets = buckets.withColumn("comp", F.col("node")) if comps is None else buckets.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    sizes = buckets.groupBy("sig").agg(F.count("*").alias("size"), F.min("node").alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return buckets.join(sizes.where("lo < hi").drop("lo", "hi"), "sig").select("sig", "node", "n", "comp", "size", "hub")


def _group_pairs(large: DataFrame, bitmaps: DataFrame, percent: int, one: bool) -> DataFrame:
    """u, v, n_u, n_v, hub: the pairs between components of the classes that have one hub in large (unsettled buckets), as far as
    sizes and bitmaps leave them; with `one`, at most one for each class. Else a hub of more classes than GROUP allows, or
    with more pairs than SMALL_BUCKET a class, has one row without a pair instead."""
    classes = large.select("hub", F.col("node").alias("u"), "comp").distinct()
    count = classes.groupBy("hub").agg((F.count("*") <= SMALL_BUCKET**GROUP).alias("fits"))
    schema = "u long, v long, n_u long, n_v long, hub long"
    names = ["u", "v", "n_u", "n_v", "hub"]

    def compared(hub, u, comp, n, bits):
        order = np.lexsort((u, n))
        n, u, comp, bits = n[order], u[order], comp[order], bits[order]
        end = np.searchsorted(n, n * 100 // percent, "right")
        left, right, pairs = [], [], 0
        for i in range(len(n) - 1):
            near = i + 1 + np.flatnonzero(comp[i + 1 : end[i]] != comp[i])
            differ = np.bitwise_count(bits[near] ^ bits[i]).sum(1, dtype=np.int64)
            near = near[(100 + percent) * differ <= (100 - percent) * (n[near] + n[i])][: 1 if one else None]
            left.append(np.full(len(near), i))
            right.append(near)
            pairs += len(near)
            if not one and pairs > SMALL_BUCKET * len(n):
                return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * 4 + [pa.array(hub[:1])], names)
        i, j = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (u[i], u[j], n[i], n[j], np.resize(hub, len(i)))], names)

    def run(batches):
        """Rows come by hub; the last hub of a batch may go on in the next."""
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [*(batch.column(k).to_numpy() for k in range(4)), batch.column(4).flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            cuts = [0, *(1 + np.flatnonzero(np.diff(rows[0]))).tolist()]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield compared(*(x[lo:hi] for x in rows))
            held = [x[cuts[-1] :] for x in rows]
        if held is not None:
            yield compared(*held)

    fit = classes.join(count.where("fits"), "hub", "left_semi")
    fit = fit.join(bitmaps.select(F.col("node").alias("u"), "n", "bitmap"), "u").select("hub", "u", "comp", "n", "bitmap")
    out = fit.repartition("hub").sortWithinPartitions("hub").mapInArrow(run, schema)
    if one:
        return out
    none = F.lit(None).cast("long")
    return out.union(count.where("not fits").select(none, none, none, none, "hub"))


def _star(large: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v, n_u, n_v, d of classes u and hubs v that share a large bucket; d is what only one of the two has."""
    pairs = materialise(large.where("node != hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct())
    return _sides(pairs, sets, "shingles").select("u", "v", "n_u", "n_v", F.concat(F.array_except("s_u", "s_v"), F.array_except("s_v", "s_u")).alias("d"))


def _pairs_within(rows: DataFrame) -> DataFrame:
    """u, v, n_u, n_v: the pairs between components of buckets that are small enough; rows has sig, node, n, comp, pairs."""
    some = rows.where(F.col("pairs") <= 2 * SMALL_BUCKET)
    u, v = (some.select("sig", F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("comp").alias(f"c_{k}")) for k in "uv")
    return u.join(v, "sig").where("u < v and c_u != c_v").select("u", "v", "n_u", "n_v").distinct()


def _pairs_across(rows: DataFrame) -> DataFrame:
    """The same between the classes apart and the others of a bucket, where one side is small."""
    some = rows.where(F.col("pairs") <= 2 * SMALL_BUCKET)
    u, v = (some.where(side).select("sig", F.col("node").alias(k), F.col("n").alias(f"n_{k}")) for k, side in (("u", "apart"), ("v", "not apart")))
    both = u.join(v, "sig").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), F.when(F.col("u") < F.col("v"), F.col("n_u")).otherwise(F.col("n_v")).alias("x"), F.when(F.col("u") < F.col("v"), F.col("n_v")).otherwise(F.col("n_u")).alias("y"))
    return both.toDF("u", "v", "n_u", "n_v").distinct()


def _by_hub(star: DataFrame) -> DataFrame:
    """v, u, n, d: the classes u that share a large bucket with its hub v, and the hubs, with their differences from them."""
    own = star.groupBy("v").agg(F.min("n_v").alias("n")).select("v", F.col("v").alias("u"), "n", F.array().cast("array<bigint>").alias("d"))
    return star.select("v", "u", F.col("n_u").alias("n"), "d").union(own)


def _by_bucket(large: DataFrame, star: DataFrame) -> DataFrame:
    """v (bucket), u, n, d: the classes of each large bucket with their differences from its hub."""
    known = star.select(F.col("u").alias("node"), F.col("v").alias("hub"), "d")
    return large.join(known, ["node", "hub"], "left").select(F.col("sig").alias("v"), F.col("node").alias("u"), "n", F.coalesce("d", F.array().cast("array<bigint>")).alias("d"))


def _few(df: DataFrame, count: int) -> DataFrame:
    return F.broadcast(df) if count <= BROADCAST else df


def _differences(rows: DataFrame, percent: int) -> DataFrame:
    """v, u, n, weight, d, least (of all weights of a v), hub (whose weight that is), direct: each class's difference from
    the consensus of the classes of one v, of rows (v, u, n, d)."""
    total = rows.groupBy("v").agg(F.count("*").alias("total"))
    counts = rows.select("v", F.explode("d").alias("g")).groupBy("v", "g").agg(F.count("*").alias("c"))
    common = materialise(counts.join(total, "v").where("2 * c > total").groupBy("v").agg(F.collect_list("g").alias("m")))
    both = rows.join(_few(common, common.agg(F.sum(F.size("m"))).first()[0] or 0), "v", "left").withColumn("m", F.coalesce("m", F.array().cast("array<bigint>")))
    both = both.select("v", "u", "n", F.concat(F.array_except("d", "m"), F.array_except("m", "d")).alias("d"))
    both = materialise(both.withColumn("weight", (100 + percent) * F.size("d").cast("long") - (100 - percent) * F.col("n")))
    least = materialise(both.groupBy("v").agg(F.min(F.struct("weight", "u")).alias("h")).select("v", F.col("h.weight").alias("least"), F.col("h.u").alias("hub")))
    out = materialise(both.join(_few(least, least.count()), "v").withColumn("direct", F.col("weight") + F.col("least") <= 0))
    discard(common, both, least)
    return out


def _next_buckets(near: DataFrame, comps: DataFrame | None, percent: int) -> DataFrame:
    """sig, node, n, comp, apart, cross, pairs: the rarest elements of each difference, as many as a pair that shares enough
    must meet in. Buckets with cross hold classes apart from their hub's component and others, those without it only classes
    apart; pairs is the least number of others that one side's classes meet."""
    step = 2 * (100 + percent)
    alone = near.select(F.col("u").alias("node")).limit(0).withColumn("comp", F.col("node"))
    comps = alone if comps is None else comps
    of_u, of_hub = comps.toDF("u", "c_u"), comps.toDF("hub", "c_hub")
    told = near.join(of_u, "u", "left").join(of_hub, "hub", "left").withColumns({"comp": F.coalesce("c_u", "u"), "home": F.coalesce("c_hub", "hub")})
    told = told.withColumn("apart", F.col("comp") != F.col("home")).drop("c_u", "c_hub", "hub", "home", "direct")
    rows = told.join(told.where("apart").select("v").distinct(), "v", "left_semi").withColumn("k", F.size("d"))

    def prefix(partner):
        return F.col("k") - F.greatest(F.lit(1), F.ceil((F.col("weight") + partner) / step)) + 1

    # Classes apart weigh at least 1 - least, as they don't link with the hub; any class weighs at least `least`.
    rows = rows.withColumn("narrow", prefix(1 - F.col("least"))).withColumn("wide", F.when(F.col("apart"), prefix(F.col("least"))).otherwise(F.col("narrow")))
    rows = materialise(rows.where("wide > 0").select("v", "u", "n", "comp", "apart", "k", "narrow", "wide", "d"))
    discard(near)
    release(near.sparkSession)
    elements = rows.select("v", "u", F.explode("d").alias("g"))
    counts = elements.groupBy("v", "g").agg(F.count("*").alias("c")).where("c > 1")
    # Elements of one class alone are the rarest and meet nobody, so they only move the ranks of the others.
    own = Window.partitionBy("v", "u")
    shared = elements.join(counts, ["v", "g"]).join(rows.drop("d"), ["v", "u"])
    ranked = shared.withColumn("r", F.col("k") - F.count("*").over(own) + F.row_number().over(own.orderBy("c", "g"))).where("r <= wide")
    kinds = F.filter(F.array(F.lit(True), F.when(F.col("apart") & (F.col("r") <= F.col("narrow")), F.lit(False))), lambda x: x.isNotNull())
    held = materialise(ranked.select(F.col("u").alias("node"), "n", "comp", "apart", "v", "g", F.explode(kinds).alias("cross")).select(F.xxhash64("v", "g", "cross").alias("sig"), "node", "n", "comp", "apart", "cross"))
    sizes = held.groupBy("sig").agg(F.count_if("apart").alias("x"), F.count_if(~F.col("apart")).alias("y"), (F.min("comp") < F.max("comp")).alias("open"), F.any_value("cross").alias("_c"))
    sizes = sizes.where("open and (not _c or x > 0 and y > 0)").select("sig", F.when(F.col("_c"), 2 * F.least("x", "y")).otherwise(F.col("x") - 1).alias("pairs"))
    out = materialise(held.join(sizes, "sig"))
    discard(rows, held)
    return out
