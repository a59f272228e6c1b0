"""Cleaning detections: confidence, non-maximum suppression, best per label, plausibility, classes, fallback, records.

A group's boxes (one image) come to one row; what they are compared with is found by cells of a grid, so a crowded image
costs what its neighbours do."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from figloom.operators.suppression import stays


def min_confidence(boxes: DataFrame, least: float, strict: bool = True) -> DataFrame:
    """Boxes above (or, not strict, at and above) a confidence."""
    return boxes.where(F.col("confidence") > least if strict else F.col("confidence") >= least)


def _suppress(boxes: DataFrame, group: str, rule: str, most: float, limit: int | None) -> DataFrame:
    """Greedy: by falling confidence, then idx, a box stays unless it clashes with one that stayed."""
    cols = [c for c in boxes.columns if c not in (group, "confidence", "idx")]
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("confidence")).alias("rank"), "idx", *cols)))
    rows = boxes.groupBy(group).agg(ranked.alias("b"))
    corners = F.transform("b", lambda x: F.struct(*(x[c].cast("double").alias(c) for c in ("x1", "y1", "x2", "y2"))))
    rows = rows.withColumn("keep", stays(corners, rule, most))
    kept = F.array_compact(F.transform("b", lambda x, i: F.when(F.get("keep", i), x)))
    kept = F.slice(kept, 1, limit) if limit else kept
    return rows.select(group, F.explode(kept).alias("k")).select(group, *(F.col(f"k.{c}") for c in ("idx", *cols)), (-F.col("k.rank")).alias("confidence"))


def nms_overlap(boxes: DataFrame, group: str, most: float) -> DataFrame:
    """Suppression by the share of the candidate that a kept box covers, above `most`, pixels counted inclusively."""
    return _suppress(boxes, group, "cover", most, None)


def nms_iou(boxes: DataFrame, group: str, most: float, limit: int | None = None) -> DataFrame:
    """Suppression by intersection over union at and above `most`; the best `limit` boxes of what stays."""
    return _suppress(boxes, group, "iou", most, limit)


def best_per_label(boxes: DataFrame, group: str) -> DataFrame:
    """The most confident box of each label, the first of equals."""
    w = Window.partitionBy(group, "label").orderBy(F.desc("confidence"), "idx")
    return boxes.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def plausible_labels(boxes: DataFrame, group: str, none: str = "z", side: int = 64) -> DataFrame:
    """Labelled boxes whose letter isn't too far on for the number of different labels, under `side` pixels (E5)."""
    counted = boxes.where(F.col("label") != none).groupBy(group).agg(F.countDistinct("label").alias("n"))
    at = F.ascii(F.lower("label")) - F.ascii(F.lit("a"))
    small = (F.col("x2") - F.col("x1") < side) & (F.col("y2") - F.col("y1") < side)
    return boxes.where(F.col("label") != none).join(counted, group).where((at < F.col("n") + 2) & small).drop("n")


def classify(scored: DataFrame, scores: str, names: list[str] | None = None) -> DataFrame:
    """Adds class_index, class_confidence (softmax of the best score, 4 decimals) and its name."""
    best = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + F.exp(x.cast("double") - best.cast("double")))
    out = scored.withColumn("class_index", (F.array_position(scores, best) - 1).cast("int")).withColumn("class_confidence", F.round(1 / total, 4))
    return out.withColumn("class_name", F.get(F.array(*map(F.lit, names)), F.col("class_index"))) if names else out


def fallback_full(figures: DataFrame, boxes: DataFrame, group: str) -> DataFrame:
    """Every figure's labelled boxes; a figure (group, width, height) without any gets one box "0" over all of it."""
    out = figures.join(boxes.select(group, "label", "x1", "y1", "x2", "y2"), group, "left")
    whole = {"label": F.lit("0"), "x1": F.lit(0), "y1": F.lit(0), "x2": F.col("width"), "y2": F.col("height")}
    missing = F.col("label").isNull()
    return out.withColumns({c: F.when(missing, v).otherwise(F.col(c)) for c, v in whole.items()}).drop("width", "height")


def score(images: DataFrame, make_predict, schema: str) -> DataFrame:
    """Detections of a user's model: make_predict() loads it once a task and returns a function of a pandas batch."""

    def run(batches):
        predict = make_predict()
        for pdf in batches:
            yield predict(pdf)

    return images.mapInPandas(run, schema)


def subfigure_records(boxes: DataFrame, group: str) -> DataFrame:
    """One row a figure with its subfigures as nested records, in order of idx."""
    from figloom.operators.geometry import to_corners

    record = F.struct("idx", "classification", "confidence", (F.col("y2") - F.col("y1")).alias("height"), (F.col("x2") - F.col("x1")).alias("width"), to_corners().alias("geometry"), F.struct(F.col("label").alias("text")).alias("subfigure_label"))
    return boxes.groupBy(group).agg(F.sort_array(F.collect_list(record)).alias("master_images"))
