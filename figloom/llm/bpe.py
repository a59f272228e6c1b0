"""Byte-level BPE encoding and decoding.

Each match of the vocabulary's pattern is merged by itself. A segment tree over its byte positions holds, at each
leaf, the rank of the pair that begins there; the root is the leftmost least one, and a merge updates the leaves of
the live neighbours only, so a piece of n bytes takes O(n log n). The trees of short pieces are worked on side by side,
as rows of one array; a longer piece has a tree of its own. Pieces recur, so each Python worker remembers the ids of
short ones it has met, up to a bound; longer ones aren't remembered.

Null texts count as empty: no ids, nothing decoded. Rows are independent: repeated rows and null ids are kept as they
are, and other columns are not read. An empty table gives an empty result. Texts and pieces may be of any length; of
equal ranks the leftmost pair is merged.
"""

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NONE = 1 << 62
#: Pieces of up to this many bytes are merged side by side and remembered.
SHORT = 64
#: Leaves of trees that are worked on at a time.
LEAVES = 1 << 16
#: Characters of texts that are encoded together.
TEXTS = 1 << 20


def read_ranks(path: str) -> bytes:
    """The vocabulary file's bytes (one base64 token and its rank a line); of the size of the vocabulary."""
    with open(path, "rb") as f:
        return f.read()


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the pair of least rank, the leftmost of equals, is merged until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    width = 1 << (n - 1).bit_length()
    get = ranks.get
    tree = [_NONE] * (2 * width)
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[width + i] = rank * width + i
    for x in range(width - 1, 0, -1):
        a, b = tree[2 * x], tree[2 * x + 1]
        tree[x] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (least := tree[1]) != _NONE:
        i = least % width
        j = after[i]
        k = after[j]
        after[i] = k
        points = [(j, _NONE), (i, _NONE)]
        if k < n:
            before[k] = i
            rank = get(piece[i : after[k]])
            if rank is not None:
                points[1] = (i, rank * width + i)
        h = before[i]
        if h >= 0:
            rank = get(piece[h:k])
            points.append((h, _NONE if rank is None else rank * width + h))
        for at, value in points:
            x = width + at
            tree[x] = value
            x >>= 1
            while x:
                a, b = tree[2 * x], tree[2 * x + 1]
                if b < a:
                    a = b
                if tree[x] == a:
                    break
                tree[x] = a
                x >>= 1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Pairs:
    """Ranks of pairs of tokens, each token named by its own rank, for many pairs at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        found = [(ranks[a] << 32 | ranks[b], rank) for token, rank in ranks.items() for k in range(1, len(token)) if (a := token[:k]) in ranks and (b := token[k:]) in ranks]
        keys, self.rank = (np.array(x, np.int64) for x in zip(*sorted(found), strict=True)) if found else (np.zeros(0, np.int64),) * 2
        # An open hash table of a quarter full: most pairs are settled at the first probe.
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys, self.at = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        left = np.arange(len(keys))
        place = self._place(keys)
        while len(left):
            free = self.keys[place] < 0
            self.keys[place[free]], self.at[place[free]] = keys[left[free]], self.rank[left[free]]
            lost = self.keys[place] != keys[left]
            left, place = left[lost], (place[lost] + 1) & (len(self.keys) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, _NONE where it has none."""
        keys = a << 32 | b
        place = self._place(keys)
        got = self.keys[place]
        out = np.where(got == keys, self.at[place], _NONE)
        look = np.flatnonzero((got != keys) & (got >= 0))
        place = place[look]
        while len(look):
            place = (place + 1) & (len(self.keys) - 1)
            got = self.keys[place]
            hit = got == keys[look]
            out[look[hit]] = self.at[place[hit]]
            more = ~hit & (got >= 0)
            look, place = look[more], place[more]
        return out


def merge_many(pieces: list[bytes], pairs: Pairs) -> list[np.ndarray]:
    """Ids of each piece, as merge() gives them; each is a row of a table of segment trees of one width, the tree's
    least leaf at place 1 of its row. All pieces have at least one byte."""
    sizes = np.array([len(p) for p in pieces])
    out: list = [None] * len(pieces)
    shift_of = np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)
    for shift in np.unique(shift_of).tolist():
        rows = np.flatnonzero(shift_of == shift)
        step = max(1, LEAVES >> shift)
        for lo in range(0, len(rows), step):
            some = rows[lo : lo + step]
            for r, ids in zip(some.tolist(), _merge_rows([pieces[r] for r in some.tolist()], sizes[some], shift, pairs), strict=True):
                out[r] = ids
    return out


def _merge_rows(pieces: list[bytes], sizes: np.ndarray, shift: int, pairs: Pairs) -> list[np.ndarray]:
    count, width = len(pieces), 1 << shift
    inside = np.arange(width) < sizes[:, None]
    token = np.full((count, width), -1, np.int64)
    token[inside] = pairs.single[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.tile(np.arange(1, width + 1), (count, 1))
    before = after - 2
    tree = np.full((count, 2 * width), _NONE, np.int64)
    r, i = np.nonzero(inside[:, 1:])
    rank = pairs(token[r, i], token[r, i + 1])
    tree[r, width + i] = np.where(rank < _NONE, (rank << shift) + i, _NONE)
    for level in range(shift, 0, -1):
        a = 1 << (level - 1)
        tree[:, a : 2 * a] = tree[:, 2 * a : 4 * a].reshape(count, a, 2).min(2)
    token, after, before, tree = token.ravel(), after.ravel(), before.ravel(), tree.ravel()
    rows = np.flatnonzero(tree[1 :: 2 * width] < _NONE)
    while len(rows):
        least = tree[rows * (2 * width) + 1]
        i = least & (width - 1)
        base = rows << shift
        j = after[base + i]
        k = after[base + j]
        token[base + i], token[base + j] = least >> shift, -1
        after[base + i] = k
        right = np.flatnonzero(k < sizes[rows])
        before[base[right] + k[right]] = i[right]
        h = before[base + i]
        left = np.flatnonzero(h >= 0)
        # Leaves that change: the merged pair's right neighbour has none any more, its own and its left neighbour's are new.
        own = np.full(len(rows), _NONE, np.int64)
        rank = pairs(token[np.concatenate([base[right] + i[right], base[left] + h[left]])], token[np.concatenate([base[right] + k[right], base[left] + i[left]])])
        value = np.where(rank < _NONE, (rank << shift) + np.concatenate([i[right], h[left]]), _NONE)
        own[right] = value[: len(right)]
        leaf = rows * (2 * width) + width
        tree[leaf + j], tree[leaf + i], tree[leaf[left] + h[left]] = _NONE, own, value[len(right) :]
        row = np.concatenate([rows, rows, rows[left]]) * (2 * width)
        place = width + np.concatenate([j, i, h[left]])
        for _ in range(shift):
            place >>= 1
            tree[row + place] = np.minimum(tree[row + 2 * place], tree[row + 2 * place + 1])
        rows = rows[tree[rows * (2 * width) + 1] < _NONE]
    live = token >= 0
    return np.split(token[live], np.cumsum(live.reshape(count, width).sum(1))[:-1])


class Codec:
    """Encoder and decoder of one vocabulary; remembers about `remember` short pieces and those of one call."""

    def __init__(self, table: bytes, pattern: str, remember: int = 200_000):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, table.splitlines()) if a}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.bytes_told = {str(v): k for v, k in self.bytes_of.items()}
        self.find = regex.compile(pattern).findall
        self.pairs = Pairs(self.ranks)
        self.remember = remember
        self.ids: dict[str, str] = {}

    def _learn(self, wanted: set[str]) -> None:
        """Adds the pieces' ids, joined by spaces."""
        short, found = {}, {}
        for p in wanted:
            raw = p.encode()
            if raw in self.ranks:
                found[p] = [self.ranks[raw]]
            elif len(raw) <= SHORT:
                short[p] = raw
            else:
                found[p] = merge(raw, self.ranks)
        found.update(zip(short, (x.tolist() for x in merge_many(list(short.values()), self.pairs)), strict=True))
        for p, ids in found.items():
            self.ids[p] = " ".join(map(str, ids))

    def coded(self, texts: list[str]) -> list[str]:
        """Of each text its ids, joined by spaces."""
        found = [self.find(t) for t in texts]
        wanted = set().union(*found).difference(self.ids)
        self._learn(wanted)
        get = self.ids.__getitem__
        out = [" ".join(map(get, f)) for f in found]
        if len(self.ids) > self.remember:
            self.ids = {}
        else:
            for p in wanted:
                if len(p) > SHORT:
                    del self.ids[p]
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [list(map(int, ids.split())) for ids in self.coded(texts)]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_told(self, ids: str) -> bytes:
        """The same of ids joined by spaces."""
        return b"".join(map(self.bytes_told.__getitem__, ids.split()))


def _together(column: pa.Array, most: int = TEXTS):
    """The column's texts in runs of up to `most` characters, a longer one by itself; nulls are empty."""
    run, size = [], 0
    for lo in range(0, len(column), 64):
        for t in column.slice(lo, 64).to_pylist():
            if run and size + len(t or "") > most:
                yield run
                run, size = [], 0
            run.append(t or "")
            size += len(t or "")
    if run:
        yield run


@lru_cache(2)
def _codec(table: bytes, pattern: str) -> Codec:
    return Codec(table, pattern)


def _mapped(docs: DataFrame, ranks_path: str, pattern: str, columns: list, schema: str, rows) -> DataFrame:
    table = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches):
        codec = _codec(table.value, pattern)
        for batch in batches:
            yield from rows(codec, batch)

    return docs.select(*columns).mapInArrow(run, schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, ids array<int>: the ids of each whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(codec, batch):
        at = 0
        for texts in _together(batch.column(1)):
            ids = pa.array(codec.encode_all(texts), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids], [id_col, "ids"])
            at += len(texts)

    return _mapped(docs, ranks_path, pattern, [id_col, text_col], f"`{id_col}` {id_type}, ids array<int>", rows)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col, text: what the ids stand for; null ids decode to the empty text, bytes that aren't UTF-8 to U+FFFD."""
    id_type = encoded.schema[id_col].dataType.simpleString()

    def rows(codec, batch):
        texts = pa.array([codec.decode(ids or []).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), texts], [id_col, "text"])

    return _mapped(encoded, ranks_path, pattern, [id_col, ids_col], f"`{id_col}` {id_type}, text string", rows)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row: the ids, and the bytes that come back from them."""

    def rows(codec, batch):
        at = 0
        for texts in _together(batch.column(1)):
            found = codec.coded(texts)
            n = [ids.count(" ") + bool(ids) for ids in found]
            back = [hashlib.sha256(codec.decode_told(ids)).hexdigest() for ids in found]
            ids = [hashlib.sha256(ids.encode()).hexdigest() for ids in found]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            at += len(texts)

    return _mapped(docs, ranks_path, pattern, [F.col("doc_id").cast("long").alias("doc_id"), "text"], "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", rows)
