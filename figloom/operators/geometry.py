"""Boxes as four columns x1, y1, x2, y2 (pixels, origin top left); corners only where nested records are read or written.

Everything is column arithmetic. Pairs of boxes are joined by their group and by cells of a grid laid over it, so a crowded
image is many tasks and only neighbours are compared; the geometry itself is tested as a residual condition."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_box(points: Column) -> list[Column]:
    """x1, y1, x2, y2 around an array of {x, y} in any order."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return [F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2")]


def to_corners() -> Column:
    """Corners top left, bottom left, top right, bottom right as array<struct<x, y>>."""
    return F.array(*(F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("x1", "y1"), ("x1", "y2"), ("x2", "y1"), ("x2", "y2"))))


def center() -> list[Column]:
    return [((F.col("x1") + F.col("x2")) / 2.0).alias("cx"), ((F.col("y1") + F.col("y2")) / 2.0).alias("cy")]


def prefixed(boxes: DataFrame, prefix: str, keep: tuple[str, ...]) -> DataFrame:
    """boxes with every column but `keep` renamed to prefix_name."""
    return boxes.select(*keep, *(F.col(c).alias(f"{prefix}_{c}") for c in boxes.columns if c not in keep))


def inside(inner: str, outer: str, pad: float = 0) -> Column:
    """The inner box lies strictly within the outer one, widened by pad on every side."""
    return (F.col(f"{inner}_x1") > F.col(f"{outer}_x1") - pad) & (F.col(f"{inner}_y1") > F.col(f"{outer}_y1") - pad) & (F.col(f"{inner}_x2") < F.col(f"{outer}_x2") + pad) & (F.col(f"{inner}_y2") < F.col(f"{outer}_y2") + pad)


#: Pixels of a grid cell's side: a cell should hold few boxes, and a box should lie in few cells.
SIDE = 256


def cell(x: Column | str, side: float) -> Column:
    """The number of the cell that a coordinate lies in."""
    return F.floor((F.col(x) if isinstance(x, str) else x) / side)


def cells(df: DataFrame, side: float, x1: Column, y1: Column, x2: Column, y2: Column) -> DataFrame:
    """df once for each cell that the box touches, with gx and gy; rows with null corners are left out."""
    across = df.withColumn("gx", F.explode(F.sequence(cell(x1, side), cell(x2, side))))
    return across.withColumn("gy", F.explode(F.sequence(cell(y1, side), cell(y2, side))))


def contained(inner: DataFrame, outer: DataFrame, group: str, pad: float = 0, side: float = SIDE) -> DataFrame:
    """Pairs of the group's boxes where the first lies in the second.

    The outer box is dealt to all cells that it covers, the inner one to that of its first corner, so a pair meets once."""
    o = cells(prefixed(outer, "out", (group,)), side, F.col("out_x1") - pad, F.col("out_y1") - pad, F.col("out_x2") + pad, F.col("out_y2") + pad)
    i = prefixed(inner, "in", (group,)).withColumns({"gx": cell("in_x1", side), "gy": cell("in_y1", side)})
    return i.join(o, [group, "gx", "gy"]).drop("gx", "gy").where(inside("in", "out", pad))


def iou_of(a, b) -> Column:
    """Intersection over union of two boxes; a and b give a column for x1, y1, x2, y2."""
    w = F.greatest(F.least(a("x2"), b("x2")) - F.greatest(a("x1"), b("x1")), F.lit(0))
    h = F.greatest(F.least(a("y2"), b("y2")) - F.greatest(a("y1"), b("y1")), F.lit(0))
    both = (a("x2") - a("x1")) * (a("y2") - a("y1")) + (b("x2") - b("x1")) * (b("y2") - b("y1")) - w * h
    return F.when(both > 0, w * h / both).otherwise(F.lit(0.0))


def overlapping(a: DataFrame, b: DataFrame, group: str, side: float = SIDE) -> DataFrame:
    """Pairs of the group's boxes (columns a_..., b_...) that overlap, each once: both are dealt to all cells that they touch,
    and a pair counts in the cell of the first corner that they have in common."""
    corners = ("x1", "y1", "x2", "y2")
    left = cells(prefixed(a, "a", (group,)), side, *(F.col(f"a_{c}") for c in corners))
    right = cells(prefixed(b, "b", (group,)), side, *(F.col(f"b_{c}") for c in corners))
    both = left.join(right, [group, "gx", "gy"]).where("a_x1 < b_x2 and b_x1 < a_x2 and a_y1 < b_y2 and b_y1 < a_y2")
    return both.where((F.col("gx") == cell(F.greatest("a_x1", "b_x1"), side)) & (F.col("gy") == cell(F.greatest("a_y1", "b_y1"), side))).drop("gx", "gy")


def iou_pairs(boxes: DataFrame, group: str, order: str, side: float = 2 * SIDE) -> DataFrame:
    """Overlapping pairs of each group's boxes, each once, with their iou."""
    pairs = overlapping(boxes, boxes, group, side).where(F.col(f"a_{order}") < F.col(f"b_{order}"))
    return pairs.withColumn("iou", iou_of(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}"))).where("iou > 0")


def near(a: DataFrame, b: DataFrame, group: str, most: float) -> DataFrame:
    """Pairs of the group's points (a: a_x, a_y; b: b_x, b_y) up to a squared distance d: a looks into the nine cells around it."""
    side = float(most) ** 0.5 + 1
    reach = side - 1
    left = cells(a, side, F.col("a_x") - reach, F.col("a_y") - reach, F.col("a_x") + reach, F.col("a_y") + reach)
    right = b.withColumns({"gx": cell("b_x", side), "gy": cell("b_y", side)})
    far = F.pow(F.col("a_x") - F.col("b_x"), F.lit(2)) + F.pow(F.col("a_y") - F.col("b_y"), F.lit(2))
    return left.join(right, [group, "gx", "gy"]).drop("gx", "gy").withColumn("d", far).where(F.col("d") <= most)


def convert(boxes: DataFrame) -> DataFrame:
    """Adds w, h (corner form) and cx, cy (centre form)."""
    return boxes.select("*", (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"), *center())


def letterbox(boxes: DataFrame, size: int = 416) -> DataFrame:
    """Box corners in a padded square of `size`; boxes has width and height of its image."""
    ratio = F.lit(float(size)) / F.greatest("width", "height")
    side = F.greatest("width", "height")
    return boxes.select("*", *(((F.col(c) + (side - F.col(d)) / 2.0) * ratio).alias(f"l{c}") for c, d in (("x1", "width"), ("y1", "height"), ("x2", "width"), ("y2", "height"))))


def unletterbox(boxes: DataFrame, size: int = 416) -> DataFrame:
    """Back from the padded square to the image: u-columns from l-columns."""
    side = F.greatest("width", "height")
    return boxes.select("*", *((F.col(f"l{c}") * side / F.lit(float(size)) - (side - F.col(d)) / 2.0).alias(f"u{c}") for c, d in (("x1", "width"), ("y1", "height"), ("x2", "width"), ("y2", "height"))))


def clamp(boxes: DataFrame, least: int = 5) -> DataFrame:
    """Boxes cut to their image (width, height), those of `least` pixels or less on a side dropped."""
    cut = {c: F.least(F.greatest(F.col(c), F.lit(0)), F.col(d)) for c, d in (("x1", "width"), ("y1", "height"), ("x2", "width"), ("y2", "height"))}
    return boxes.withColumns(cut).where((F.col("x2") - F.col("x1") > least) & (F.col("y2") - F.col("y1") > least))


#: Boxes of an image that are cut at a time.
CUTS = 16


def _let(value: Column, body) -> Column:
    """body of the value, which is read once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def crop(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pixels of each box: images has figure_id, width, height, channels, data (row by row); boxes figure_id, idx and corners.

    An image's boxes are gathered to one array and meet the image where it lies: the boxes' side is hashed, so pixels are neither
    sorted nor broadcast, and they travel only where images aren't dealt by figure_id yet. A crop is the pieces of its rows,
    one behind another, cut and joined as bytes within Spark, CUTS boxes at a time. Data of another size than the image's is
    an error; a null corner or null data give null data."""
    own = boxes.groupBy("figure_id").agg(F.collect_list(F.struct("idx", "x1", "y1", "x2", "y2")).alias("boxes"))
    own = own.withColumn("boxes", F.transform(F.sequence(F.lit(1), F.size("boxes"), F.lit(CUTS)), lambda i: F.slice("boxes", i, CUTS)))
    joined = images.select("figure_id", "width", "height", "channels", "data").join(own.hint("shuffle_hash"), "figure_id")
    rows = joined.select("figure_id", "width", "height", "channels", "data", F.explode("boxes").alias("boxes"))
    zero, bad = F.lit(0), F.raise_error(F.lit("image data of another size than width * height * channels"))

    def edge(c: Column, most: str) -> Column:
        """A corner, moved to the image's edge where it lies outside, as slices of an array have it."""
        return F.when(c.isNotNull(), F.least(F.greatest(c, zero), F.col(most)).cast("int"))

    def pixels(data: Column, b: Column) -> Column:
        def line(y: Column) -> Column:
            return F.substring(data, (y * F.col("width") + b["x1"]) * F.col("channels") + 1, (b["x2"] - b["x1"]) * F.col("channels")).cast("string")

        # Bytes as strings are joined as they are; nothing reads them as letters.
        found = F.array_join(F.transform(F.sequence(b["y1"], b["y2"] - 1), line), "").cast("binary")
        known = b["x1"].isNotNull() & b["y1"].isNotNull() & b["x2"].isNotNull() & b["y2"].isNotNull()
        return F.when(known & data.isNotNull(), F.when((b["x2"] > b["x1"]) & (b["y2"] > b["y1"]), found).otherwise(F.lit(b"")))

    def cut(data: Column) -> Column:
        told = F.when(F.octet_length(data) != F.col("width").cast("long") * F.col("height") * F.col("channels"), bad).otherwise(data)
        size = lambda x, lo, hi: F.greatest(x[hi] - x[lo], zero)
        return _let(told, lambda d: F.transform("edges", lambda x: F.struct(x["idx"].cast("int").alias("idx"), size(x, "x1", "x2").alias("width"), size(x, "y1", "y2").alias("height"), pixels(d, x).alias("data"))))

    corners = (("x1", "width"), ("y1", "height"), ("x2", "width"), ("y2", "height"))
    rows = rows.withColumn("edges", F.transform("boxes", lambda b: F.struct(b["idx"].alias("idx"), *(edge(b[c], most).alias(c) for c, most in corners))))
    return rows.select("figure_id", F.explode(_let(F.col("data"), cut)).alias("c")).select("figure_id", "c.idx", "c.width", "c.height", "c.data")
