"""Merkle manifest of a dataset: a digest for each row, trees over them, and a proof for each row by pointer jumping.

A leaf is the digest of a row's fields. Within each group (source) leaves ascend by key, and every three consecutive nodes
have a parent until one is left, the group's subroot; subroots, in order of the groups, likewise give the root. H is the
lowercase hex SHA-256 of its inputs one behind the other, digests as hex text.

Rows get their places from a range partitioning by group, key and digest and the counts of earlier partitions, so a group
of a third of all rows is many tasks. Up to 81 neighbours (four levels) meet in one row by a grouping, where the levels
between are built by array functions; that is repeated for their tops. Then every node at the foot of such a block points
to its ancestor at the block's top (the subroot is the foot of the upper tree) and holds the segment of siblings in between;
repeated self-joins on the pointer double the distance and concatenate segments until every leaf points past the root. Of the
nodes that are pointed to there are an 81st of the rows at most, and ever fewer on later joins, on which ever more rows
share one: they are broadcast up to `BROADCAST_NODES` (segments grow with the tree's depth only) and shuffled beyond.

Null fields are told from empty ones by the leaf's form; a null key or group comes first. Rows that repeat a key are ordered
by digest; equal rows have equal leaves, each with a proof of its own. A single row is its own root, with an empty proof;
an empty table gives an empty result. Texts may be of any length; they are read once, and only digests are shuffled. Columns
other than the named ones are left out, so no name can clash.
"""

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from figloom.functions.session import discard, materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
#: Levels that are built within one row.
LEVELS = 4
BLOCK = FAN**LEVELS
#: Ancestors are broadcast up to this many rows, each of some hundred bytes.
BROADCAST_NODES = 20_000
#: Places of groups in partitions are broadcast up to this many rows and bytes of group names.
BROADCAST_RUNS, BROADCAST_BYTES = 100_000, 16 << 20
_POWERS = [FAN**k for k in range(40)]


def leaf(fields) -> Column:
    """The digest of a row: each field (columns or names) as `-` if null, else its UTF-8 byte count, `:`, and its value."""
    told = [F.col(f).cast("string") if isinstance(f, str) else f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in told)).cast("binary"), 256)


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, lambda d: F.hex(d)), "")


def _parent(digests: Column) -> Column:
    return F.unhex(F.sha2(F.lower(_joined(digests)).cast("binary"), 256))


def _parents(digests: Column) -> Column:
    """The parents of digests in a row, three to one."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FAN).cast("int")), lambda m: _parent(F.slice(digests, m * FAN + 1, FAN)))


def fold(leaf_hex: Column, segment: Column) -> Column:
    """The root that a leaf (hex text) and its siblings give."""
    return F.aggregate(segment, leaf_hex, lambda d, s: F.sha2(F.concat(_text(s["l"]), d, _text(s["r"])).cast("binary"), 256))


def proof(segment: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.lower(F.array_join(F.transform(segment, lambda s: F.concat(F.hex(s["l"]), F.hex(s["r"]))), "")).cast("binary"), 256)


def _sorted(df: DataFrame, order: list[str]) -> DataFrame:
    """df, range-partitioned and sorted by order, with _part and _row (its place in the partition), as a written table."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialise(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_part"), row.alias("_row")))


def _before(runs: DataFrame, *group: str) -> Column:
    """How many rows of the group earlier partitions hold: a group has one run a partition."""
    w = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("here").over(w), F.lit(0)) - F.col("first")


def _few(df: DataFrame, group: str) -> DataFrame:
    size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(group).cast("string")))).first()
    return F.broadcast(df) if size[0] <= BROADCAST_RUNS and (size[1] or 0) <= BROADCAST_BYTES else df


def _placed(leaves: DataFrame):
    """leaves (s, k, d, tie, more) with g (the group's rank), n (its rows) and i (the row's place in it); the number of
    groups, the rows of the largest, and the tables written."""
    rows = _sorted(leaves, ["s", "k", "d", "tie"])
    runs = materialise(rows.groupBy("s", "_part").agg(F.count(F.lit(1)).alias("here"), F.min("_row").alias("first")))
    groups = _sorted(runs.groupBy("s").agg(F.sum("here").alias("n")), ["s"])
    starts = groups.groupBy("_part").agg(F.count(F.lit(1)).alias("here"), F.min("_row").alias("first"))
    starts = starts.select("_part", _before(starts).alias("before"))
    ranked = groups.join(starts, "_part").select(F.col("s").alias("s_"), "n", (F.col("_row") + F.col("before")).alias("g"))
    places = runs.select("s", "_part", _before(runs, "s").alias("before")).join(ranked, F.col("s").eqNullSafe(F.col("s_"))).select("s_", F.col("_part").alias("part_"), "before", "n", "g")
    placed = rows.join(_few(places, "s_"), F.col("s").eqNullSafe(F.col("s_")) & (F.col("_part") == F.col("part_"))).withColumn("i", F.col("_row") + F.col("before")).drop("s", "s_", "_part", "part_", "_row", "before", "tie")
    total, largest = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    return placed, total, largest, [rows, runs, groups]


def _depth(n: int) -> int:
    return sum(p < n for p in _POWERS)


def _blocks(nodes: DataFrame, base: int, more: list[str] = ()) -> DataFrame:
    """Nodes of one level (g, n, i, d, more), 81 neighbours a row: up, how many levels are left above them (to its tree's
    top), members, and the digests of these and the levels above, h0 to h4 (a tree that ends sooner repeats its top)."""
    up = F.size(F.filter(F.array(*map(F.lit, _POWERS)), lambda p: p < F.col("n"))) - base
    out = nodes.groupBy("g", F.expr(f"i div {BLOCK}").alias("b")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "d", *more))).alias("members"))
    out = out.withColumn("up", up).withColumn("h0", F.transform("members", lambda m: m["d"]))
    for j in range(LEVELS):
        out = out.withColumn(f"h{j + 1}", F.when(F.col("up") > j, _parents(F.col(f"h{j}"))).otherwise(F.col(f"h{j}")))
    return out


def _node(g, base, i) -> Column:
    return F.struct(g.cast("long").alias("g"), F.lit(base).alias("b"), i.cast("long").alias("i"))


def _nodes(blocks: DataFrame, base: int, upper: bool, more: list[str] = ()) -> DataFrame:
    """The members of the blocks as nodes: id, p (the pointer; null past the root), seg (siblings on the way, left and right
    of it, a level each), sub (the subroot if it is reached), more."""
    top = F.element_at(f"h{LEVELS}", 1)
    ends = F.col("up") <= LEVELS
    past = F.lit(None) if upper else _node(F.lit(-1), 0, F.col("g"))
    rows = blocks.select("g", "b", "up", *(f"h{j}" for j in range(LEVELS)), F.when(ends & F.lit(not upper), top).alias("sub"), F.when(ends, past).otherwise(_node(F.col("g"), base + LEVELS, F.col("b"))).alias("p"), F.posexplode("members").alias("o", "m"))
    siblings = []
    for j in range(LEVELS):
        run, at = F.floor(F.col("o") / FAN ** (j + 1)).cast("int") * FAN, F.floor(F.col("o") / FAN**j).cast("int") % FAN
        left, right = F.slice(f"h{j}", run + 1, at), F.slice(f"h{j}", run + at + 2, FAN - 1 - at)
        siblings.append(F.when(F.col("up") > j, F.struct(F.unhex(_joined(left)).alias("l"), F.unhex(_joined(right)).alias("r"))))
    return rows.select(_node(F.col("g"), base, F.col("m.i")).alias("id"), "p", F.array_compact(F.array(*siblings)).alias("seg"), "sub", *(F.col(f"m.{c}").alias(c) for c in more))


def _tree(nodes: DataFrame, depth: int, upper: bool, more: list[str]):
    """All blocks of trees of up to this depth, level by level: the written blocks and the trees' tops (g, d)."""
    written, tops, base = [], [], 0
    while True:
        blocks = materialise(_blocks(nodes, base, more if base == 0 else []))
        top = F.element_at(f"h{LEVELS}", 1).alias("d")
        written.append(blocks)
        tops.append(blocks.where(F.col("up") <= LEVELS).select("g", top))
        nodes = blocks.where(F.col("up") > LEVELS).select("g", "n", F.col("b").alias("i"), top)
        base += LEVELS
        if base >= depth:
            return written, functools.reduce(DataFrame.union, tops)


def proofs(docs: DataFrame, fields=FIELDS, key: str = "doc_id", group: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """key, the columns to carry (of other names than s, k, d, g, n, i, tie), leaf, subroot, root (hex), and segment: for each
    level the digests left and right of the row's ancestor, as bytes."""
    leaves = materialise(docs.select(F.col(group).alias("s"), F.col(key).alias("k"), F.unhex(leaf(fields)).alias("d"), *carry, F.monotonically_increasing_id().alias("tie")))
    placed, groups, largest, kept = _placed(leaves)
    if not groups:
        return docs.select(key, *carry, *(F.lit("").alias(c) for c in ("leaf", "subroot", "root")), F.array().cast("array<struct<l:binary,r:binary>>").alias("segment")).limit(0)
    more = ["k", *carry]
    blocks, subroots = _tree(placed, _depth(largest), False, more)
    discard(leaves, *kept)
    upper, tops = _tree(subroots.select(F.lit(-1).alias("g"), F.lit(groups).cast("long").alias("n"), F.col("g").alias("i"), "d"), _depth(groups), True, [])
    root = tops.first()["d"].hex()
    nodes = _nodes(blocks[0], 0, False, ["d", *more])
    above = [_nodes(b, k * LEVELS, False) for k, b in enumerate(blocks) if k] + [_nodes(b, k * LEVELS, True) for k, b in enumerate(upper)]
    ancestors = materialise(functools.reduce(DataFrame.union, above))
    distance, hops = 1, len(blocks) + len(upper)
    while distance < hops:
        found = ancestors.select(F.col("id").alias("q"), F.col("p").alias("p2"), F.col("seg").alias("seg2"), F.col("sub").alias("sub2"))
        found = F.broadcast(found) if ancestors.count() <= BROADCAST_NODES else found

        def jumped(df, found=found):
            far = df.join(found, F.col("p") == F.col("q"), "left")
            return far.withColumns({"seg": F.when(F.col("seg2").isNull(), F.col("seg")).otherwise(F.concat("seg", "seg2")), "sub": F.coalesce("sub", "sub2"), "p": F.col("p2")}).drop("q", "p2", "seg2", "sub2")

        nodes, distance = jumped(nodes), 2 * distance
        if distance < hops:
            ancestors = materialise(jumped(ancestors))
    return nodes.select(F.col("k").alias(key), *carry, _text(F.col("d")).alias("leaf"), _text(F.col("sub")).alias("subroot"), F.lit(root).alias("root"), F.col("seg").alias("segment"))
