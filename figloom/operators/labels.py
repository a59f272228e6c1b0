"""Label spans of captions by a token-class automaton over Arrow columns, all kinds of labels in one pass.

Bytes become tokens (words, runs of white space, single marks), and tokens classes: for each kind of label whether a word
is one, joiners, brackets, colons, full stops, words of reference. A run of labels is a chain of label, joiner, label; where
each chain ends is found for all tokens at once by doubling jumps. A span is a run set off by brackets or colons on both
sides or on one, or a form of its own, and of those that overlap the first counts. A span behind words of reference
("shown in (b)") is told as such.

Words are runs of letters, digits, underscores and characters beyond ASCII but dashes, quotes and the like (U+2000-206F). A
null caption has no spans."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from figloom.functions.arrowtext import as_bytes, first_of_overlapping, slices

# Words of position that serve as labels, and the roman numerals up to fifty.
POSITIONS = ["above", "after", "around", "before", "beginning", "behind", "below", "beside", "between", "bottom", "center", "down", "end", "far", "finish", "front", "in", "inside", "lower", "left", "middle", "near", "next to", "off", "on", "out", "outside", "over", "right", "start", "through", "top", "under", "up", "upper", "upside down"]
ROMAN = [t + u for t in ("", "x", "xx", "xxx", "xl") for u in ("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")][1:] + ["l"]
#: Kinds of labels, in the order in which a tie is told.
KINDS = ("alpha", "ALPHA", "digit", "roman", "position")
# Words before a label that only refers to a subfigure.
REFERENCES = ["denoted", "corresponds", "extracted", "indicated", "shown", "corresponding"]
BETWEEN = ["in", "by", "to", "from"]
SPANS = "array<struct<kind:string,span:string,pos:int,refers:boolean>>"

_KNOWN = sorted({*ROMAN, *(w for p in POSITIONS for w in p.split()), "and", *REFERENCES, *BETWEEN})
_WORD, _SPACE, _BREAK = 1, 2, 3
_CLASS = np.array([_WORD if chr(b).isalnum() and b < 128 or b == 95 or b >= 128 else _SPACE if b in (9, 10, 11, 12, 13, 32) else 256 + b for b in range(256)])
_DASH, _OTHER = 1000, 1001


class _Tokens:
    """Tokens of many captions, a break before and behind each: where they start and stop, their classes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        rows = len(offsets) - 1
        # A byte of zero between captions keeps their tokens apart.
        place = np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets)) + 1
        self.data = np.zeros(len(data) + rows + 2, np.uint8)
        self.data[place] = data
        kind = _CLASS[self.data]
        kind[self.data == 0] = _BREAK
        mark = np.flatnonzero((self.data[:-2] == 0xE2) & np.isin(self.data[1:-1], (0x80, 0x81)))
        for k in range(3):
            kind[mark + k] = _OTHER
        dash = mark[(self.data[mark + 1] == 0x80) & (self.data[mark + 2] == 0x93)]
        for k in range(3):
            kind[dash + k] = _DASH
        single = kind >= _BREAK
        begins = np.ones(len(kind), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | single[1:]
        for k in (1, 2):
            begins[mark + k] = False
        self.start = np.flatnonzero(begins)
        self.stop = np.append(self.start[1:], len(kind))
        self.kind = np.append(kind[self.start], [_BREAK] * 6)  # what lies beyond the last token is a break
        self.kind[-7:] = _BREAK
        self.first = offsets[:-1] + np.arange(rows) + 1  # where each caption begins
        n = len(self.start)
        self.size = np.zeros(n + 6, np.int64)
        self.size[:n] = self.stop - self.start
        self.n = n
        words = np.flatnonzero(self.kind[:n] == _WORD)
        short = words[self.size[words] <= 13]
        lower = pc.ascii_lower(slices(self.data, self.start[short], self.stop[short]))
        self.word = np.full(n + 6, -1)
        self.word[short] = pc.index_in(lower, pa.array(_KNOWN, pa.large_string())).fill_null(-1).to_numpy(zero_copy_only=False)
        self.byte = np.zeros(n + 6, np.int64)
        self.byte[:n] = self.data[self.start]
        self.blank = (self.kind == _SPACE) & (self.size == 1) & (self.byte == 32)

    def mark(self, c: str) -> np.ndarray:
        return self.kind == 256 + ord(c)

    def among(self, words) -> np.ndarray:
        return np.isin(self.word, [_KNOWN.index(w) for w in words])

    def label(self, kind: str) -> np.ndarray:
        """How many tokens the label that begins at each token has, 0 if there is none."""
        one = (self.kind == _WORD) & (self.size == 1)
        b = self.byte
        if kind == "alpha":
            return (one & (b >= 97) & (b <= 122)).astype(int)
        if kind == "ALPHA":
            return (one & (b >= 65) & (b <= 90)).astype(int)
        if kind == "digit":
            return (one & (b >= 48) & (b <= 57)).astype(int)
        if kind == "roman":
            return self.among(ROMAN).astype(int)
        out = self.among([p for p in POSITIONS if " " not in p]).astype(int)
        for p in (p.split() for p in POSITIONS if " " in p):
            both = self.among([p[0]])[:-2] & self.blank[1:-1] & self.among([p[1]])[2:]
            out[:-2][both] = 3
        return out

    def numbered(self, kind: str) -> np.ndarray:
        """Words of a letter of the kind and a digit."""
        two = (self.kind == _WORD) & (self.size == 2)
        second = np.zeros_like(self.byte)
        second[: self.n] = self.data[np.minimum(self.start + 1, len(self.data) - 1)]
        low, high = (97, 122) if kind == "alpha" else (65, 90)
        return two & (self.byte >= low) & (self.byte <= high) & (second >= 48) & (second <= 57)


def _run_ends(t: _Tokens, size: np.ndarray) -> np.ndarray:
    """For each token at which a run of labels begins the token behind the run."""
    n = len(size)
    space, comma, joins = t.kind == _SPACE, t.mark(","), (t.kind == _DASH) | t.mark("-") | t.among(["and"])

    def skip(at, what):
        return np.minimum(at + what[at], n - 1)

    at = np.flatnonzero(size)
    j = skip(np.minimum(at + size[at], n - 1), space)
    listed = comma[j]
    other = joins[j] & ~listed
    j = np.minimum(j + (listed | other), n - 1)
    j = skip(j, space)
    j = np.where(listed, skip(skip(j, t.among(["and"])), space), j)
    goes = (listed | other) & (size[j] > 0)
    last = np.arange(n)
    last[at[goes]] = j[goes]
    while (last[last] != last).any():
        last = last[last]
    return np.minimum(last + size[last], n - 1)


def _matches(t: _Tokens, kind: str):
    """First token and token behind the last of each span of a kind."""
    size = t.label(kind)
    ends = _run_ends(t, size)
    n = t.n
    bracket, close, colon = t.mark("("), t.mark(")"), t.mark(":")
    starts, stops = [], []

    def put(at, behind):
        starts.append(at)
        stops.append(behind)

    at = np.flatnonzero(bracket[:n] & (size[1 : n + 1] > 0))
    put(at, ends[at + 1] + close[ends[at + 1]])
    at = np.flatnonzero(colon[:n] & (size[1 : n + 1] > 0))
    put(at, ends[at + 1] + colon[ends[at + 1]])
    at = np.flatnonzero(size[:n])
    at = at[(close[ends[at]] | colon[ends[at]]) & ~bracket[at - 1]]  # behind a bracket that is a span already
    put(at, ends[at] + 1)
    if kind in ("alpha", "ALPHA"):
        at = np.flatnonzero(bracket[:n] & t.numbered(kind)[1 : n + 1] & close[2 : n + 2])
        put(at, at + 3)
    if kind == "alpha":
        at = np.flatnonzero(t.mark(".")[:n] & t.blank[1 : n + 1] & (size[2 : n + 2] > 0))
        more = t.mark(",")[at + 3] | (t.kind == _DASH)[at + 3]
        second = at + 4 + t.blank[np.minimum(at + 4, n + 5)]
        second = np.minimum(second, n + 5)
        put(at, np.where(more & (size[second] > 0), second + 1, at + 3))
    starts, stops = np.concatenate(starts), np.concatenate(stops)
    order = np.lexsort((-stops, starts))
    starts, stops = starts[order], stops[order]
    keep = first_of_overlapping(starts, stops)
    return starts[keep], stops[keep]


def _referred(t: _Tokens) -> np.ndarray:
    """Tokens inside brackets behind a word of reference."""
    n = t.n
    verb, between = t.among(REFERENCES), t.among(BETWEEN)
    marks = np.flatnonzero((t.mark("(") | t.mark(")"))[:n])
    opens = np.flatnonzero(t.mark("(")[:n])
    opens = opens[opens >= 4]
    behind = t.blank[opens - 1] & (verb[opens - 2] | (between[opens - 2] & t.blank[opens - 3] & verb[opens - 4]))
    opens = opens[behind]
    other = np.append(marks, n)[np.searchsorted(marks, opens, "right")]
    closed = t.mark(")")[other]
    breaks = np.cumsum(t.kind[:n] == _BREAK)
    closed &= breaks[np.minimum(other, n - 1)] == breaks[opens]
    change = np.zeros(n + 1, int)
    np.add.at(change, opens[closed], 1)
    np.add.at(change, other[closed], -1)
    return np.cumsum(change) > 0


def parse(texts: pa.Array) -> pa.Array:
    """The spans of each caption, by kind and place: kind, span, pos (the character it begins at, from 1), refers."""
    data, offsets = as_bytes(texts)
    t = _Tokens(data, offsets)
    referred = _referred(t)
    letters = np.cumsum((t.data & 0xC0) != 0x80)
    kind, starts, stops = [], [], []
    for k, name in enumerate(KINDS):
        a, b = _matches(t, name)
        kind.append(np.full(len(a), k))
        starts.append(a)
        stops.append(b)
    kind, starts, stops = np.concatenate(kind), np.concatenate(starts), np.concatenate(stops)
    row = np.searchsorted(t.first, t.start[starts], "right") - 1
    order = np.lexsort((starts, kind, row))
    kind, starts, stops, row = kind[order], starts[order], stops[order], row[order]
    pos = letters[t.start[starts]] - letters[t.first[row]] + 1 if len(row) else row
    span = slices(t.data, t.start[starts], t.stop[stops - 1]).cast(pa.string())
    fields = [pa.array(np.array(KINDS, object)[kind], pa.string()), span, pa.array(pos.astype(np.int32)), pa.array(referred[starts])]
    found = pa.StructArray.from_arrays(fields, ["kind", "span", "pos", "refers"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(offsets))).astype(np.int32)), found)


def spans(text: Column) -> Column:
    """The spans of all kinds of a caption."""
    return F.arrow_udf(parse, SPANS)(text)
