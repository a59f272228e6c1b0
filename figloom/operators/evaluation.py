"""Predictions against truth, annotation sets and metric series."""

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from figloom.functions.ordering import earlier, in_order
from figloom.functions.session import materialise
from figloom.operators.geometry import iou_of
from figloom.operators.matching import MOST_SETTINGS, matched


def match_truth(truth: DataFrame, found: DataFrame, group: str, near: float = 100.0) -> DataFrame:
    """Each truth point (idx, cx, cy) in order takes the nearest free prediction up to `near` (squared); counts of both.

    One image's points are folded in one row."""
    t = truth.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("idx", "cx", "cy"))).alias("t"))
    p = found.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("idx", "cx", "cy"))).alias("p"))
    both = t.join(p, group, "left").withColumn("p", F.coalesce("p", F.array().cast(p.schema["p"].dataType)))
    start = F.array().cast("array<bigint>")

    def step(used: Column, x: Column) -> Column:
        free = F.filter("p", lambda y: ~F.array_contains(used, y["idx"].cast("bigint")))
        far = F.transform(free, lambda y: F.struct((F.pow(y["cx"] - x["cx"], F.lit(2)) + F.pow(y["cy"] - x["cy"], F.lit(2))).alias("d"), y["idx"].cast("bigint").alias("i")))
        best = F.array_min(far)
        return F.when(best["d"] <= near, F.concat(used, F.array(best["i"]))).otherwise(used)

    out = both.withColumn("used", F.aggregate("t", start, step))
    return out.select(group, F.size("used").alias("matched"), (F.size("t") - F.size("used")).alias("missed"), (F.size("p") - F.size("used")).alias("extra"))


def nm_error(predicted: DataFrame, correct: DataFrame, keys: list[str]) -> DataFrame:
    """Relative error of nm against the truth."""
    return predicted.select(*keys, "nm").join(correct.select(*keys, F.col("nm").alias("true_nm")), keys).withColumn("error", F.abs(F.col("nm") - F.col("true_nm")) / F.col("true_nm"))


def accuracy_at(scored: DataFrame, thresholds: list[float]) -> DataFrame:
    """Accuracy and count of the rows at or above each confidence; scored has confidence and correct."""
    at = scored.select("confidence", "correct", F.explode(F.array(*map(F.lit, thresholds))).alias("threshold")).where("confidence >= threshold")
    return at.groupBy("threshold").agg(F.count("*").alias("n"), F.avg(F.col("correct").cast("int")).alias("accuracy"))


def class_accuracy(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Accuracy of each model; truth of an unknown class counts as -1 and is skipped (I4)."""
    known = found.join(classes, "class_name", "left").withColumn("truth", F.coalesce("class_index", F.lit(-1)))
    judged = F.col("truth") >= 0
    return known.groupBy("model").agg(F.avg(F.when(judged, (F.col("truth") == F.col("predicted")).cast("int"))).alias("accuracy"), F.count_if(~judged).alias("skipped"))


def to_annotations(boxes: DataFrame, group: str) -> DataFrame:
    """Annotations with an id from 1 within the image, width-height boxes and area."""
    return boxes.select(group, F.row_number().over(Window.partitionBy(group).orderBy("idx")).alias("id"), (F.col("kind") + 1).alias("category"), F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"), ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area"))


def clean_annotations(boxes: DataFrame) -> DataFrame:
    """No crowds, boxes cut to the image, degenerate ones dropped; boxes has crowd, width, height."""
    cut = {c: F.least(F.greatest(F.col(c), F.lit(0)), F.col(d)) for c, d in (("x1", "width"), ("y1", "height"), ("x2", "width"), ("y2", "height"))}
    return boxes.where("not crowd").withColumns(cut).where("x2 > x1 and y2 > y1")


def drop_empty_images(images: DataFrame, annotations: DataFrame, group: str) -> DataFrame:
    """Images with at least one box over a pixel on both sides."""
    return images.join(annotations.where("w > 1 and h > 1").select(group), group, "left_semi")


def remap_categories(annotations: DataFrame, wanted: list[int]) -> DataFrame:
    """Annotations of the wanted categories, numbered by their place among them (I8)."""
    table = F.array(*map(F.lit, wanted))
    return annotations.where(F.col("category").isin(*wanted)).withColumn("category", (F.array_position(table, F.col("category")) - 1).cast("int"))


#: Ranges of box areas (pixels) by name, and numbers of detections of an image that are looked at.
AREAS = {"all": (0.0, 1e10), "small": (0.0, 32.0**2), "medium": (32.0**2, 96.0**2), "large": (96.0**2, 1e10)}
MOST = (1, 10, 100)
#: Ranges of confidence whose counts are summed first, so that no running sum passes through one task.
RANGES = 1000


def _flags(truth: DataFrame, found: DataFrame, group: str, settings: list[tuple[float, float, float, int]]) -> DataFrame:
    """setting (its place in the list), confidence, n, tp: predictions that count, and those that hit.

    Predictions are ranked and joined with the truth that they overlap by the figure; an image's pairs come to one row, where
    all settings are matched at once."""
    size = ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).cast("double")
    corners = ("x1", "y1", "x2", "y2")
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("confidence"), "idx"))
    p = found.select(group, F.col("confidence").cast("double").alias("confidence"), size.alias("size"), *(F.col(c).alias(f"p_{c}") for c in corners), rank.alias("rank")).where(F.col("rank") <= max(s[3] for s in settings))
    t = truth.select(F.col(group).alias("_g"), F.col("idx").cast("bigint").alias("truth"), size.alias("truth_size"), *(F.col(c).alias(f"t_{c}") for c in corners))
    iou = iou_of(lambda c: F.col(f"p_{c}"), lambda c: F.col(f"t_{c}"))
    pairs = p.join(t, (F.col(group) == F.col("_g")) & (iou >= min(s[0] for s in settings)), "left").withColumn("iou", F.when(F.col("truth").isNotNull(), iou))
    row = F.struct("rank", (-F.col("iou")).alias("far"), "truth", "confidence", "size", "iou", "truth_size")
    images = pairs.groupBy(group).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    told = images.select(F.explode(matched(F.col("rows"), settings)).alias("f"))
    counts = told.select("f.*", F.explode(F.sequence(F.lit(0), F.lit(len(settings) - 1))).alias("setting")).where("(counted >> setting) & 1 = 1")
    return counts.groupBy("setting", "confidence").agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr("(hit >> setting) & 1")).alias("tp"))


def _scores(truth: DataFrame, found: DataFrame, group: str, settings: list[tuple[float, str, int]], areas: dict[str, tuple[float, float]]) -> DataFrame:
    """threshold, area, most, ap, recall of each setting (threshold, area, most)."""
    flags = _flags(truth, found, group, [(t, *areas[a], m) for t, a, m in settings]).withColumn("part", F.floor(F.col("confidence") * RANGES))
    parts = flags.groupBy("setting", "part").agg(F.sum("n").alias("n0"), F.sum("tp").alias("tp0"))
    above = Window.partitionBy("setting").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("setting", "part", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(c) for c in ("n0", "tp0")))
    w = Window.partitionBy("setting", "part").orderBy(F.desc("confidence"))
    curve = flags.join(parts, ["setting", "part"]).select("setting", (F.sum("tp").over(w) + F.col("tp0")).alias("tp"), (F.sum("n").over(w) + F.col("n0")).alias("n"))
    size = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    totals = truth.agg(*(F.count_if((size >= lo) & (size <= hi)).alias(a) for a, (lo, hi) in areas.items()))
    wanted = totals.select(F.explode(F.array(*(F.struct(F.lit(k).alias("setting"), F.lit(t).alias("threshold"), F.lit(a).alias("area"), F.lit(m).alias("most"), F.col(a).alias("total")) for k, (t, a, m) in enumerate(settings)))).alias("s")).select("s.*").where("total > 0")
    curve = curve.join(F.broadcast(wanted.select("setting", "total")), "setting").select("setting", (F.col("tp") / F.col("total")).alias("recall"), (F.col("tp") / F.col("n")).alias("precision"))
    points = curve.groupBy("setting", F.floor(F.col("recall") * 100 + 1e-9).alias("point")).agg(F.max("precision").alias("precision"), F.max("recall").alias("recall"))
    # The best precision from a recall on holds for all points up to it that lie beyond the next lower recall met.
    down = Window.partitionBy("setting").orderBy(F.desc("point"))
    best = F.max("precision").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lower = F.coalesce(F.lead("point").over(down), F.lit(-1))
    scores = points.select("setting", "recall", (best * (F.col("point") - lower)).alias("share")).groupBy("setting").agg((F.sum("share") / 101).alias("ap"), F.max("recall").alias("recall"))
    return wanted.join(F.broadcast(scores), "setting", "left").select("threshold", "area", "most", F.coalesce("ap", F.lit(0.0)).alias("ap"), F.coalesce("recall", F.lit(0.0)).alias("recall"))


def precision_recall(truth: DataFrame, found: DataFrame, group: str, thresholds: list[float], areas: dict[str, tuple[float, float]] | None = None, most: int = MOST[-1]) -> DataFrame:
    """threshold, area, most, ap (interpolated at 101 points), recall, of the `most` surest predictions of each image.

    Each image's predictions, by falling confidence, take the free truth box of most overlap, one within the area range
    before one outside. Truth outside counts for nothing, nor do predictions that take it or that are outside themselves
    and take none. A range that holds no truth has no row, ap is 0 where no prediction counts."""
    areas = areas or {"all": AREAS["all"]}
    settings = [(t, a, most) for t in thresholds for a in areas]
    parts = [_scores(truth, found, group, settings[k : k + MOST_SETTINGS], areas) for k in range(0, len(settings), MOST_SETTINGS)]
    return functools.reduce(DataFrame.union, parts)


def average_precision(truth: DataFrame, found: DataFrame, group: str, thresholds: list[float]) -> DataFrame:
    """threshold, ap, recall over boxes of all sizes."""
    return precision_recall(truth, found, group, thresholds).select("threshold", "ap", "recall")


def detection_summary(truth: DataFrame, found: DataFrame, group: str) -> DataFrame:
    """metric, value: the twelve numbers of a detection report, mean over overlaps .50 to .95 where none is named."""
    thresholds = [0.5 + 0.05 * k for k in range(10)]
    settings = [(t, a, MOST[-1]) for t in thresholds for a in AREAS] + [(t, "all", m) for t in thresholds for m in MOST[:-1]]
    rows = _scores(truth, found, group, settings, AREAS)
    full, whole = F.col("most") == MOST[-1], F.col("area") == "all"
    told = {"AP": (full & whole, "ap"), "AP50": (full & whole & (F.col("threshold") == 0.5), "ap"), "AP75": (full & whole & (F.col("threshold") == 0.75), "ap")}
    told |= {f"AP_{a}": (full & (F.col("area") == a), "ap") for a in AREAS if a != "all"}
    told |= {f"AR{k}": (whole & (F.col("most") == k), "recall") for k in MOST}
    told |= {f"AR_{a}": (full & (F.col("area") == a), "recall") for a in AREAS if a != "all"}
    means = rows.agg(*(F.avg(F.when(c, F.col(v))).alias(k) for k, (c, v) in told.items()))
    return means.select(F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in told))).alias("m")).select("m.*")


def smooth(series: DataFrame, name: str, order: list[str], value: str, last: int = 20) -> DataFrame:
    """Mean, maximum and lower median of the last values, the latest value, and the mean so far.

    A series is cut into ranges of its order, one a partition. Sums and counts of earlier ranges are added to those within a
    range, and each range is given the few rows before it, so no window spans a whole series."""
    rows = in_order(series.select(F.col(name).alias("_name"), *order, F.col(value).alias("_v")), ["_name", *order])
    runs = rows.groupBy("_name", "_part").agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("n"), F.count("_v").alias("some"), F.sum("_v").alias("total"))
    before = {c: F.coalesce(F.sum(c).over(earlier("_name")), F.lit(0)).alias(f"{c}_before") for c in ("n", "some", "total")}
    runs = materialise(runs.select("_name", "_part", "first", "n", *before.values()))
    told = runs.select(F.col("_name").alias("r_name"), F.col("_part").alias("r_part"), "first", "n", *(f"{c}_before" for c in before))
    placed = rows.join(told, F.col("_name").eqNullSafe(F.col("r_name")) & (F.col("_part") == F.col("r_part"))).withColumn("at", F.col("n_before") + F.col("_row") - F.col("first"))
    own = placed.select("_name", "_part", *order, "_v", "at", F.lit(False).alias("carried"), "some_before", "total_before")
    # The last rows of a run go to every run that starts so soon behind them that its windows reach back.
    tails = placed.where(F.col("_row") - F.col("first") >= F.col("n") - (last - 1)).select("_name", *order, "_v", "at", F.explode(F.sequence(F.col("at") + 1, F.col("at") + last - 1)).alias("start"))
    starts = told.where("n_before > 0").select("r_name", F.col("r_part").alias("_part"), F.col("n_before").alias("start"), "some_before", "total_before")
    tails = tails.withColumnRenamed("start", "t_start").join(starts, F.col("_name").eqNullSafe(F.col("r_name")) & (F.col("t_start") == F.col("start")))
    carried = tails.select("_name", "_part", *order, "_v", "at", F.lit(True).alias("carried"), "some_before", "total_before")
    w = Window.partitionBy("_name", "_part").orderBy("at")
    recent, so_far = w.rowsBetween(-(last - 1), 0), w.rowsBetween(Window.unboundedPreceding, 0)
    held = F.sort_array(F.collect_list("_v").over(recent))
    mine = F.when(~F.col("carried"), F.col("_v"))
    total, some = F.coalesce(F.sum(mine).over(so_far), F.lit(0)) + F.col("total_before"), F.count(mine).over(so_far) + F.col("some_before")
    out = own.unionByName(carried).select(F.col("_name").alias(name), *order, "carried", F.avg("_v").over(recent).alias("mean"), F.max("_v").over(recent).alias("most"), F.get(held, F.floor((F.size(held) - 1) / 2).cast("int")).alias("median"), F.last("_v").over(recent).alias("last"), F.when(some > 0, total / some).alias("global_mean"))
    return out.where("not carried").drop("carried")


def reduce_metrics(metrics: DataFrame, name: str, value: str, mean: bool = True) -> DataFrame:
    """Metrics of several workers as one."""
    return metrics.groupBy(name).agg((F.avg if mean else F.sum)(value).alias("value"))


def sample_figures(figures: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n figures by the order of a seeded hash."""
    return figures.orderBy(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), key).limit(n)


def diff_results(found: DataFrame, expected: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """Keys whose rows differ: numbers to `digits` places, nulls equal, one-sided keys told."""
    columns = [c for c in expected.columns if c != key]

    def normal(df, side):
        return df.select(key, *(F.round(c, digits).alias(f"{side}_{c}") if dict(df.dtypes)[c] in ("double", "float") else F.col(c).alias(f"{side}_{c}") for c in columns), F.lit(True).alias(f"in_{side}"))

    both = normal(found, "a").join(normal(expected, "b"), key, "full")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    state = F.when(F.col("in_b").isNull(), "extra").when(F.col("in_a").isNull(), "missing").when(~same, "different")
    return both.select(key, state.alias("state")).where("state is not null")
