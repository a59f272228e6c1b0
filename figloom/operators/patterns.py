"""Many patterns at once: an Aho-Corasick automaton in numpy arrays, run over Arrow columns.

States are numbered level by level, so the moves of all states are one sorted array of (state, byte); shallow states, where a
scan spends its time, have a full row of moves, failures resolved, and the few steps beyond them are looked up. Texts
are cut into lanes of equal length that overlap by the longest pattern, and all lanes take their steps side by side, so a long
text costs what many short ones of its length do.

The automaton goes to the tasks as a broadcast of bounded size: a set of patterns of more than `most_bytes` is dealt by hash
into several automata, each scanned in turn. A pattern is found wherever its bytes occur (as `contains` has it), case as
written."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figloom.functions.arrowtext import as_bytes

#: States with a full row of moves: 32 KB of them are a megabyte.
DENSE = 8192
#: Bytes of patterns in one automaton: its arrays take some 30 times as much at most.
MOST_BYTES = 2_000_000
#: Bytes of texts that are scanned at a time, and of a lane at least.
BLOCK, LANE = 8 << 20, 512


class Automaton:
    """All places of a set of different, non-empty patterns (bytes)."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        size = np.array([len(p) for p in patterns], np.int64)
        self.longest = int(size.max(initial=0))
        data = np.frombuffer(b"".join(patterns), np.uint8)
        begin = np.cumsum(size) - size
        node = np.zeros(len(patterns), np.int64)
        keys, fail, own, count, levels = [], [np.zeros(1, np.int64)], [np.full(1, -1)], 1, []
        for level in range(self.longest):
            here = np.flatnonzero(size > level)
            key, inverse = np.unique(node[here] * 256 + data[begin[here] + level], return_inverse=True)
            node[here] = count + inverse
            mine = np.full(len(key), -1)
            ends = here[size[here] == level + 1]
            mine[node[ends] - count] = ends
            keys.append(key)
            own.append(mine)
            levels.append((count, len(key)))
            count += len(key)
        self.keys, self.own = np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate(own)
        self.fail, self.more = np.zeros(count, np.int64), np.full(count, -1)
        for first, n in levels:
            key = self.keys[first - 1 : first - 1 + n]
            above, byte = key // 256, key % 256
            self.fail[first : first + n] = np.where(above > 0, self._after(self.fail[above], byte), 0)
            to = self.fail[first : first + n]
            self.more[first : first + n] = np.where(self.own[to] >= 0, to, self.more[to])
        dense = min(count, DENSE)
        self.rows = np.zeros((dense, 256), np.int32)
        self.rows[0, self.keys[self.keys < 256]] = 1 + np.flatnonzero(self.keys < 256)
        for first, n in levels:
            states = np.arange(first, min(first + n, dense))
            self.rows[states] = self.rows[self.fail[states]]
            at = slice(*np.searchsorted(self.keys, [first * 256, (first + n) * 256]))
            key = self.keys[at]
            told = key // 256 < dense
            self.rows[key[told] // 256, key[told] % 256] = (np.arange(at.start, at.stop) + 1)[told]
        self.tells = (self.own >= 0) | (self.more >= 0)

    def _after(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The state behind a byte: down the failures until one has the move, else the root."""
        out, open_, state = np.zeros(len(state), np.int64), np.arange(len(state)), state.copy()
        while len(open_):
            key = state[open_] * 256 + byte[open_]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            has = self.keys[at] == key
            out[open_[has]] = at[has] + 1
            open_ = open_[~has & (state[open_] > 0)]
            state[open_] = self.fail[state[open_]]
        return out

    def held(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, pattern) of every pattern that a text holds, each pair once, in order."""
        data, offsets = as_bytes(texts)
        found = [np.zeros(0, np.int64)]
        lo = 0
        while lo < len(offsets) - 1 and self.patterns:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK, "right")) - 1)
            found.append(self._block(data, offsets, lo, hi))
            lo = hi
        both = np.unique(np.concatenate(found))
        return both // max(1, len(self.patterns)), both % max(1, len(self.patterns))

    def _block(self, data, offsets, lo, hi):
        lane = max(LANE, 2 * self.longest)
        sizes = offsets[lo + 1 : hi + 1] - offsets[lo:hi]
        lanes = -(-sizes // lane)
        row = np.repeat(np.arange(lo, hi), lanes)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        stop = np.minimum(offsets[row] + (nth + 1) * lane, offsets[row + 1])
        at = np.maximum(offsets[row] + nth * lane - self.longest + 1, offsets[row])
        order = np.argsort(at - stop, kind="stable")
        row, at, long = row[order], at[order], (stop - at)[order]
        left = np.searchsorted(-long, -np.arange(long[0] if len(long) else 0), "left")
        state, states, hits, waiting = np.zeros(len(row), np.int64), len(self.own), [], 0
        dense, flat = len(self.rows), self.rows.ravel()
        for step, k in enumerate(left):
            state = state[:k]
            byte = data[at[:k] + step].astype(np.int64)
            if states <= dense:
                state = flat[state * 256 + byte].astype(np.int64)
            else:
                deep = np.flatnonzero(state >= dense)
                to = flat[np.minimum(state, dense - 1) * 256 + byte].astype(np.int64)
                if len(deep):
                    to[deep] = self._after(state[deep], byte[deep])
                state = to
            tells = np.flatnonzero(self.tells[state])
            if len(tells):
                hits.append(row[tells] * states + state[tells])
                waiting += len(tells)
                if waiting > 1 << 21:
                    hits = [np.unique(np.concatenate(hits))]
                    waiting = 0
        both = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
        row, state = both // states, both % states
        out = []
        while len(row):
            told = self.own[state] >= 0
            out.append(row[told] * len(self.patterns) + self.own[state[told]])
            row, state = row[self.more[state] >= 0], self.more[state[self.more[state] >= 0]]
        return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)


def with_held(df: DataFrame, text: str, patterns: DataFrame, column: str = "held", most_bytes: int = MOST_BYTES) -> DataFrame:
    """df with an array of the labels that its text holds a pattern of, each once, sorted; patterns has (pattern, label).

    Null and empty patterns and null labels are left out; a null text holds none; patterns may have several labels."""
    told = patterns.select("pattern", "label").where("pattern != '' and label is not null").distinct()
    size = told.agg(F.sum(F.octet_length("pattern") + F.octet_length("label"))).first()[0] or 0
    blocks = -(-size // most_bytes)
    out = df.withColumn(column, F.array().cast("array<string>"))
    for k in range(blocks):
        rows = told.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k).collect()
        labels: dict[bytes, list[str]] = {}
        for r in rows:
            labels.setdefault(r["pattern"].encode(), []).append(r["label"])
        out = out.withColumn(column, F.array_sort(F.array_union(column, _held(df, labels)(F.col(text)))))
    return out


def _held(df: DataFrame, labels: dict[bytes, list[str]]):
    shared = df.sparkSession.sparkContext.broadcast((Automaton(sorted(labels)), [labels[p] for p in sorted(labels)]))

    def found(texts: pa.Array) -> pa.Array:
        automaton, names = shared.value
        row, pattern = automaton.held(texts)
        at = np.searchsorted(row, np.arange(len(texts) + 1))
        return pa.array([sorted({x for p in pattern[a:b].tolist() for x in names[p]}) for a, b in zip(at[:-1], at[1:], strict=True)], pa.list_(pa.string()))

    return F.arrow_udf(found, "array<string>")


def holds_none(df: DataFrame, text: Column | str, patterns: DataFrame) -> DataFrame:
    """df without the rows whose text holds a pattern (column pattern)."""
    told = patterns.select("pattern", F.lit("").alias("label"))
    return with_held(df.withColumn("_text", F.col(text) if isinstance(text, str) else text), "_text", told, "_held").where(F.size("_held") == 0).drop("_text", "_held")
