"""HTML pages as tables of nodes: one linear pass over the bytes of many pages, nodes numbered in document order.

A node is an element or a piece of text. `pre` counts nodes from 0 in document order, `post` is the last node inside, so the
descendants of a node are the nodes with pre < x <= post: structural joins are comparisons of two numbers, and within a
page's array the descendants are a slice. Tags, comments, raw elements and quoted attributes are told apart by numpy over
all pages of a batch side by side; pages whose tags pair up are nested by sorting, and only those of others walk a stack.

An element ends at its end tag, which also ends those still open inside it; at a start tag that can't stand in it (a block
in a p, an li in an li, and so on); or with its parent. End tags of nothing are passed over. Comments, declarations and
the text of script and style are no nodes; a null page has none. Character references are resolved in text."""

import html as _references

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figloom.functions.arrowtext import as_bytes, first_of_overlapping, slices

NODES = "array<struct<pre:int,post:int,parent:int,tag:string,attrs:string,text:string,start:int,stop:int>>"
# Elements without an end tag, elements whose text holds no tags, and what ends what.
VOID = "area base br col embed hr img input link meta source track wbr".split()
RAW = "script style title textarea".split()
ENDS_P = "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table ul".split()
ENDED_BY = {"p": ENDS_P, "li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "tr": ["tr", "tbody", "tfoot"], "td": ["td", "th", "tr", "tbody", "tfoot"], "th": ["td", "th", "tr", "tbody", "tfoot"], "option": ["option", "optgroup"]}
# Elements that keep what is around them from being ended, unless they are ended themselves.
WALLS = "html body table td th ul ol dl select button object template caption".split()
TEXT, OPEN, CLOSE, EMPTY = range(4)


def _next(places: np.ndarray, after: np.ndarray, none: np.ndarray) -> np.ndarray:
    """The first of places (rising) at or behind each number, none where there is none or it lies behind that."""
    at = np.searchsorted(places, after)
    found = np.append(places, np.iinfo(np.int64).max)[at]
    return np.minimum(found, none)


def _tag_ends(data, starts, page_ends):
    """Behind the `>` of each tag, not counting those in quoted attributes."""
    double, single = np.flatnonzero(data == 34), np.flatnonzero(data == 39)
    special = np.flatnonzero((data == 34) | (data == 39) | (data == 62))
    ends, at, open_ = page_ends.copy(), starts.copy(), np.arange(len(starts))
    while len(open_):
        s = _next(special, at[open_], page_ends[open_])
        inside = s < page_ends[open_]
        kind = np.where(inside, data[np.minimum(s, len(data) - 1)], 62)
        ends[open_[kind == 62]] = np.minimum(s[kind == 62] + 1, page_ends[open_[kind == 62]])
        open_, s, kind = open_[kind != 62], s[kind != 62], kind[kind != 62]
        value = np.isin(data[s - 1], [61, 32, 9, 10, 13])
        close = np.where(kind == 34, _next(double, s + 1, page_ends[open_]), _next(single, s + 1, page_ends[open_]))
        at[open_] = np.where(value & (close < page_ends[open_]), close, s) + 1
    return ends


def _lower_names(data, starts, stops):
    names = pc.ascii_lower(slices(data, starts, stops)).dictionary_encode()
    return names.indices.to_numpy(zero_copy_only=False).astype(np.int64), names.dictionary.to_pylist()


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Tags and texts of all pages in order: kind, page, start, stop, name (code), where attributes begin and end; the names."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    lt = np.flatnonzero(data == 60)
    letter = lambda b: ((b | 32) >= 97) & ((b | 32) <= 122)
    one, two = padded[lt + 1], padded[lt + 2]
    opens, closes, other = letter(one), (one == 47) & letter(two), (one == 33) | (one == 63)
    lt, opens, closes, other = (x[opens | closes | other] for x in (lt, opens, closes, other))
    page = np.searchsorted(offsets, lt, "right") - 1
    page_end = offsets[page + 1]
    comment = other & (padded[lt + 1] == 33) & (padded[lt + 2] == 45) & (padded[lt + 3] == 45)
    dashes = np.flatnonzero((data[: n - 2] == 45) & (data[1 : n - 1] == 45) & (data[2:] == 62)) if n > 2 else np.zeros(0, np.int64)
    gt = np.flatnonzero(data == 62)
    stop = np.minimum(_next(gt, lt, page_end) + 1, page_end)
    stop[opens] = _tag_ends(data, lt[opens] + 1, page_end[opens])
    stop[comment] = np.minimum(_next(dashes, lt[comment] + 2, page_end[comment]) + 3, page_end[comment])
    breaks = np.flatnonzero(np.isin(data, [9, 10, 12, 13, 32, 47, 62]))
    name_at = lt + 1 + closes
    name_end = np.where(other, name_at, _next(breaks, name_at, stop))
    code, names = _lower_names(data, name_at, name_end)
    codes = {x: i for i, x in enumerate(names)}
    is_a = lambda words: np.isin(code, [codes[w] for w in words if w in codes])
    slash = opens & (padded[stop - 2] == 47) & (padded[stop - 1] == 62) & (stop - 2 >= name_end)
    empty = opens & (slash | is_a(VOID))
    # What a tag covers: itself, a raw element's text, too.
    cover = stop.copy()
    for word in RAW:
        mine = opens & ~empty & is_a([word])
        if mine.any():
            cover[mine] = _next(lt[closes & is_a([word])], stop[mine], page_end[mine])
    kept = np.flatnonzero(first_of_overlapping(lt, cover))
    # Texts go from each tag's end, and each page's beginning, to the next tag or the page's end.
    pages = len(offsets) - 1
    text_at, text_page = np.concatenate([offsets[:-1], stop[kept]]), np.concatenate([np.arange(pages), page[kept]])
    text_end = _next(lt[kept], text_at, offsets[text_page + 1])
    silent = np.concatenate([np.zeros(pages, bool), (opens & ~empty & is_a(["script", "style"]))[kept]])
    real = (text_end > text_at) & ~silent
    text_at, text_end = text_at[real], text_end[real]
    tag = kept[~other[kept]]
    start = np.concatenate([lt[tag], text_at])
    order = np.argsort(start, kind="stable")
    none = np.full(len(text_at), -1)
    put = lambda tags, texts: np.concatenate([tags, texts])[order]
    kind = put(np.where(closes[tag], CLOSE, np.where(empty[tag], EMPTY, OPEN)), np.full(len(text_at), TEXT))
    attrs_end = stop[tag] - 1 - slash[tag]
    return kind, np.searchsorted(offsets, start[order], "right") - 1, start[order], put(stop[tag], text_end), put(code[tag], none), put(name_end[tag], none), put(attrs_end, none), names


def _stack(kinds, names, told):
    """For one page's tokens: where each element's parent opens (-1: none) and the token that ends it (len: none does)."""
    ended, walls = told
    n = len(kinds)
    parent, close, open_, count = [-1] * n, [n] * n, [], {}
    watched: list[tuple[int, int]] = []  # of the open elements those that may be ended, and the walls: how many are around them, name

    def end(depth, at):
        for i in open_[depth:]:
            close[i] = at
            count[names[i]] -= 1
        del open_[depth:]
        while watched and watched[-1][0] >= depth:
            watched.pop()

    for at, (kind, name) in enumerate(zip(kinds, names, strict=True)):
        if kind == CLOSE:
            if count.get(name):
                depth = len(open_) - 1
                while names[open_[depth]] != name:
                    depth -= 1
                end(depth, at)
            continue
        if kind != TEXT:
            outermost = None
            for depth, above in reversed(watched):
                if name in ended.get(above, ()):
                    outermost = depth
                elif above in walls:
                    break
            if outermost is not None:
                end(outermost, at)
        parent[at] = open_[-1] if open_ else -1
        if kind == OPEN:
            if name in ended or name in walls:
                watched.append((len(open_), name))
            open_.append(at)
            count[name] = count.get(name, 0) + 1
    return parent, close


def _nested(kind, page, code, names):
    """The token at which each token's parent opens (-1: none), and the token that ends each element."""
    n = len(kind)
    codes = {x: i for i, x in enumerate(names)}
    step = np.where(kind == OPEN, 1, np.where(kind == CLOSE, -1, 0))
    depth = np.cumsum(step)
    level = np.where(kind == OPEN, depth - 1, depth)  # of elements and texts: how many are open around them
    pages = page.max(initial=-1) + 1
    wrong = np.zeros(pages, bool)
    first = np.searchsorted(page, np.arange(pages))
    base = np.concatenate([[0], depth])[first]
    wrong |= np.concatenate([[0], depth])[np.searchsorted(page, np.arange(pages), "right")] != base
    np.logical_or.at(wrong, page, depth < base[page])
    parent, close = np.full(n, -1), np.full(n, n)
    # Of each level's tags every second one ends the one before.
    tags = np.flatnonzero((kind == OPEN) | (kind == CLOSE))
    tags = tags[~wrong[page[tags]]]
    order = tags[np.lexsort((tags, level[tags]))]
    a, b = order[0::2], order[1::2]
    odd = (code[a] != code[b]) | (kind[a] != OPEN) | (kind[b] != CLOSE) | (page[a] != page[b])
    wrong[page[a[odd]]] = True
    close[a] = b
    # The parent is the last element opened one level up.
    opened = np.flatnonzero(kind == OPEN)
    opened = opened[np.lexsort((opened, level[opened]))]
    key = level[opened] * (n + 1) + opened
    inner = np.flatnonzero((kind != CLOSE) & (level > base[page]))
    parent[inner] = opened[np.maximum(np.searchsorted(key, (level[inner] - 1) * (n + 1) + inner) - 1, 0)]
    # Start tags that may end something: an element that they end is open.
    ended = {codes[x]: {codes[y] for y in ys if y in codes} for x, ys in ENDED_BY.items() if x in codes}
    for above, below in ended.items():
        opened_now = np.cumsum(np.where(code == above, step, 0))
        at = np.flatnonzero(np.isin(code, list(below)) & ((kind == OPEN) | (kind == EMPTY)))
        around = opened_now[at] - ((code[at] == above) & (kind[at] == OPEN))
        wrong[page[at[around > np.concatenate([[0], opened_now])[first][page[at]]]]] = True
    told = (ended, {codes[x] for x in WALLS if x in codes})
    stops = np.searchsorted(page, np.arange(pages), "right")
    for k in np.flatnonzero(wrong):
        lo, hi = first[k], stops[k]
        up, down = _stack(kind[lo:hi].tolist(), code[lo:hi].tolist(), told)
        up, down = np.array(up, np.int64), np.array(down, np.int64)
        parent[lo:hi], close[lo:hi] = np.where(up < 0, -1, up + lo), down + lo
    return parent, close


def parse(html: pa.Array) -> pa.Array:
    """The nodes of each page."""
    data, offsets = as_bytes(html)
    kind, page, start, stop, code, attrs_at, attrs_end, names = _tokens(data, offsets)
    parent, close = _nested(kind, page, code, names)
    node = kind != CLOSE
    count = np.concatenate([[0], np.cumsum(node)])  # nodes before each token
    rows = np.flatnonzero(node)
    first = count[np.searchsorted(page, np.arange(len(offsets) - 1))]
    own, at = page[rows], count[rows]
    ends = np.where(kind[rows] == OPEN, close[rows], rows + 1)
    # Behind its end tag; where none ends it, where the next token starts, or the page ends.
    edge = np.concatenate([start, [len(data)]])
    real_end = (np.append(kind, TEXT)[ends] == CLOSE) & (np.append(code, -1)[ends] == code[rows]) & (np.append(page, -1)[ends] == own)
    end_byte = np.where(kind[rows] != OPEN, stop[rows], np.where(real_end, np.append(stop, len(data))[ends], np.minimum(edge[ends], offsets[own + 1])))
    is_text = kind[rows] == TEXT
    text = slices(data, np.where(is_text, start[rows], 0), np.where(is_text, stop[rows], 0))
    told = np.flatnonzero(pc.match_substring(text, "&").to_numpy(zero_copy_only=False)) if len(text) else np.zeros(0, int)
    if len(told):
        mask = np.zeros(len(text), bool)
        mask[told] = True
        text = pc.replace_with_mask(text, pa.array(mask), pa.array([_references.unescape(x) for x in text.take(pa.array(told)).to_pylist()], pa.large_string()))
    text = pc.if_else(pa.array(is_text), text, pa.scalar(None, pa.large_string()))
    attrs = pc.if_else(pa.array(~is_text), slices(data, np.where(is_text, 0, attrs_at[rows]), np.where(is_text, 0, attrs_end[rows])), pa.scalar(None, pa.large_string()))
    tag = pa.array(np.append(np.array(names, object), None)[code[rows]] if len(rows) else [], pa.string())
    int32 = lambda x: pa.array(x.astype(np.int32))
    up = np.where(parent[rows] < 0, -1, count[np.maximum(parent[rows], 0)] - first[own]) if len(rows) else rows
    fields = [int32(at - first[own]), int32(count[ends] - 1 - first[own]), int32(up), tag, attrs.cast(pa.string()), text.cast(pa.string()), int32(start[rows] - offsets[own]), int32(end_byte - offsets[own])]
    nodes = pa.StructArray.from_arrays(fields, ["pre", "post", "parent", "tag", "attrs", "text", "start", "stop"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(own, np.arange(len(offsets))).astype(np.int32)), nodes)


def tree(html: Column) -> Column:
    """The page's nodes, in document order."""
    return F.arrow_udf(parse, NODES)(html)


def node_table(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key and the nodes' columns, a row a node."""
    return pages.select(key, F.inline(tree(F.col(html))))


def within(inner: DataFrame, outer: DataFrame, key: str) -> DataFrame:
    """Pairs of nodes of one page, the inner one a descendant of the outer: key, outer_pre, and inner's columns."""
    o = outer.select(F.col(key).alias("_k"), F.col("pre").alias("outer_pre"), F.col("post").alias("_post"))
    return inner.join(o, (F.col(key) == F.col("_k")) & (F.col("pre") > F.col("outer_pre")) & (F.col("pre") <= F.col("_post"))).drop("_k", "_post")


def attribute(attrs: Column, name: str) -> Column:
    """The value of an attribute, quoted or not; null without it."""
    pattern = rf"""(?is)(?:^|[\s"']){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*(F.regexp_extract(attrs, pattern, k) for k in (1, 2, 3)))
    return F.when(attrs.rlike(pattern), F.replace(value, F.lit("&amp;"), F.lit("&")))


def has_class(node: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(F.split(attribute(node["attrs"], "class"), r"\s+"), name), F.lit(False))


def elements(nodes: Column, tag: str, class_name: str | None = None) -> Column:
    """The nodes of a tag (and class) among nodes."""
    return F.filter(nodes, lambda x: (x["tag"] == tag) & (has_class(x, class_name) if class_name else F.lit(True)))


def inside(nodes: Column, node: Column) -> Column:
    """The descendants of a node among all nodes of its page: a slice."""
    return F.slice(nodes, node["pre"] + 2, node["post"] - node["pre"])


def text_of(nodes: Column, node: Column) -> Column:
    """All text inside a node, in order."""
    return F.array_join(F.transform(inside(nodes, node), lambda x: x["text"]), "")


def outer(html: Column, node: Column) -> Column:
    """The node as the page writes it."""
    return F.substring(html.cast("binary"), node["start"] + 1, node["stop"] - node["start"]).cast("string")
