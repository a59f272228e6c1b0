"""Physical scale from detected bars and label texts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from figloom.operators.geometry import contained, near

# Short unit forms, the units a read label may have, and nanometres of each unit.
SHORT_UNITS = {"n": "nm", "c": "cm", "u": "um"}
LABEL_UNITS = ["nm", "mm", "cm", "um", "a"]
NANOMETRES = {"a": 0.1, "nm": 1.0, "um": 1e3, "mm": 1e6, "cm": 1e7, "m": 1e9}
#: A label further from a bar than this (squared distance of centres) isn't its label.
NEAR = 5000
#: Label classes of the reader: digits, point, letters, space; the blank is the last.
CLASSES = list("0123456789") + [".", " "] + list("acmnuACMN")


def _lookup(pairs: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), key)


def label_number(text: Column) -> Column:
    return F.regexp_extract(text, r"^\s*([0-9]*\.?[0-9]+)\s*[A-Za-z]+\s*$", 1)


def label_unit(text: Column) -> Column:
    unit = F.lower(F.regexp_extract(text, r"^\s*[0-9]*\.?[0-9]+\s*([A-Za-z]+)\s*$", 1))
    return F.coalesce(_lookup(SHORT_UNITS, unit), unit)


def is_valid_label(text: Column) -> Column:
    """A number and a unit that labels may have."""
    return F.coalesce((label_number(text) != "") & label_unit(text).isin(LABEL_UNITS), F.lit(False))


def normal_label(text: Column) -> Column:
    return F.concat(label_number(text), F.lit(" "), label_unit(text))


def first_valid(nbest: DataFrame, group: str) -> DataFrame:
    """The first valid reading of each group by rank, in normal form; "-1" where none is (F1)."""
    ok = F.when(is_valid_label(F.col("text")), F.col("rank"))
    out = nbest.groupBy(group).agg(F.min_by(F.when(is_valid_label(F.col("text")), normal_label(F.col("text"))), ok).alias("reading"))
    return out.withColumn("reading", F.coalesce("reading", F.lit("-1")))


def decode_indices(indices: Column, classes: list[str] = CLASSES) -> Column:
    """Text of class indices; those beyond the classes are blanks and leave nothing (F2)."""
    table = F.array(*map(F.lit, classes))
    return F.array_join(F.transform(F.filter(indices, lambda i: i < len(classes)), lambda i: F.get(table, i)), "")


def encode_label(text: Column, classes: list[str] = CLASSES, length: int = 32) -> Column:
    """Class indices of a text's characters (unknown ones left out), padded with the blank to `length`."""
    table = F.array(*map(F.lit, classes))
    known = F.filter(F.transform(F.split(text, ""), lambda c: F.array_position(table, c) - 1), lambda i: i >= 0)
    return F.slice(F.concat(known, F.array_repeat(F.lit(len(classes)).cast("long"), length)), 1, length)


def split_label(labels: DataFrame) -> DataFrame:
    """Adds number and unit of the text, null where there is none."""
    return labels.withColumn("number", label_number(F.col("text")).try_cast("double")).withColumn("unit", F.nullif(label_unit(F.col("text")), F.lit("")))


def truncated(x: Column, digits: int) -> Column:
    """Cut off, not rounded."""
    return (x * 10**digits).cast("long") / float(10**digits)


def to_nm(labels: DataFrame) -> DataFrame:
    """Adds nm, cut to 2 decimals; null for texts without a known unit."""
    return split_label(labels).withColumn("nm", truncated(F.col("number") * _lookup(NANOMETRES, F.col("unit")), 2))


def split_objects(boxes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scale lines with their length in pixels, and scale labels."""
    return boxes.where("kind = 1").withColumn("length", F.col("x2") - F.col("x1")), boxes.where("kind = 2")


def nearest_label(lines: DataFrame, labels: DataFrame, group: str, keep_unmatched: bool = True) -> DataFrame:
    """Each line with its nearest label up to NEAR, the first of equals; distance -1 and null label without one."""
    a = lines.withColumnRenamed("idx", "line_idx")
    x, y = (F.col("x1") + F.col("x2")) / 2.0, (F.col("y1") + F.col("y2")) / 2.0
    pairs = near(a.select(group, "line_idx", x.alias("a_x"), y.alias("a_y")), labels.select(group, F.col("idx").alias("label_idx"), x.alias("b_x"), y.alias("b_y")), group, NEAR)
    best = pairs.groupBy(group, "line_idx").agg(F.min(F.struct("d", "label_idx")).alias("m"))
    out = a.join(best, [group, "line_idx"], "left" if keep_unmatched else "inner")
    return out.withColumn("label_idx", F.col("m.label_idx")).withColumn("distance", F.coalesce("m.d", F.lit(-1.0))).drop("m")


def unmatched_labels(labels: DataFrame, matched: DataFrame, group: str) -> DataFrame:
    """Labels that no line took (F8)."""
    taken = matched.where("label_idx is not null").select(group, F.col("label_idx").alias("idx")).distinct()
    return labels.join(taken, [group, "idx"], "left_anti")


def assign_to_subfigure(objects: DataFrame, subfigures: DataFrame, group: str) -> DataFrame:
    """Scale objects with the first subfigure (by idx) that contains them."""
    return contained(objects, subfigures, group).groupBy(group, "in_idx").agg(F.min("out_idx").alias("subfigure_idx"))


def unassigned(objects: DataFrame, assigned: DataFrame, group: str) -> DataFrame:
    """Scale objects in no subfigure."""
    return objects.join(assigned.select(group, F.col("in_idx").alias("idx")), [group, "idx"], "left_anti")


def physical_size(subfigures: DataFrame, bars: DataFrame, group: str) -> DataFrame:
    """Subfigures with nm_width and nm_height, where their bars (subfigure_idx, line_idx, length, nm) say one nm; by the last bar."""
    told = bars.where("nm is not null and length > 0").groupBy(group, F.col("subfigure_idx").alias("idx"))
    ratio = told.agg(F.countDistinct("nm").alias("n"), F.max_by(F.col("nm") / F.col("length"), "line_idx").alias("ratio")).where("n = 1")
    out = subfigures.join(ratio.drop("n"), [group, "idx"], "left")
    return out.select("*", *(truncated(F.col("ratio") * (F.col(f"{c}2") - F.col(f"{c}1")), 1).alias(f"nm_{n}") for c, n in (("x", "width"), ("y", "height"))))


def bigram_model(corpus: DataFrame, text: str = "text") -> DataFrame:
    """first, second, n, p: pairs of neighbouring characters of a corpus and P(second | first).

    One pass of a look-ahead over each text finds its pairs, so a text costs in proportion to its length."""
    pairs = corpus.select(F.explode(F.regexp_extract_all(text, F.lit(r"(?s)(?=(..))."), F.lit(1))).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    split = pairs.select(F.substring("pair", 1, 1).alias("first"), F.substring("pair", 2, 1).alias("second"), "n")
    return split.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("first")))


def word_list(corpus: DataFrame, text: str = "text") -> DataFrame:
    """word, n: of the lower-cased runs of letters, digits and _, those of letters alone."""
    words = corpus.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))).alias("word"))
    return words.where(F.col("word").rlike(r"^\p{L}+$")).groupBy("word").agg(F.count("*").alias("n"))
