"""Captions joined to subfigures, nested figures, and the six flat tables made of them.

All joins and groupings are on the figure (or article), so each figure's few rows meet in one task and nothing else
does; nothing is gathered beyond one figure's record."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Codes of the classes that the result tables know.
CLASS_CODES = {"microscopy": "MC", "diffraction": "DF", "graph": "GR", "basic_photo": "PH", "illustration": "IL", "unclear": "UN", "parent": "PT"}


def _none() -> Column:
    return F.array().cast("array<string>")


def clean_label(c: Column) -> Column:
    return F.lower(F.translate(F.trim(c), "().", ""))


def _numbered(df: DataFrame, group: str, order: str) -> DataFrame:
    label = clean_label(F.col("label"))
    return df.withColumn("_l", label).withColumn("_n", F.row_number().over(Window.partitionBy(group, "_l").orderBy(order)))


def assign_captions(subfigures: DataFrame, captions: DataFrame, group: str) -> DataFrame:
    """Subfigures with caption, keywords and general of the caption entry of their label, one to one in order; empty
    arrays without one. captions: group, pos, label, caption, keywords, general (arrays) (G1)."""
    right = _numbered(captions, group, "pos").select(group, "_l", "_n", "caption", "keywords", "general")
    out = _numbered(subfigures, group, "idx").join(right, [group, "_l", "_n"], "left").drop("_l", "_n")
    return out.withColumns({c: F.coalesce(c, _none()) for c in ("caption", "keywords", "general")})


def unassigned_captions(subfigures: DataFrame, captions: DataFrame, group: str) -> DataFrame:
    """Caption entries that no subfigure took."""
    taken = _numbered(subfigures, group, "idx").select(group, "_l", "_n")
    return _numbered(captions, group, "pos").join(taken, [group, "_l", "_n"], "left_anti").drop("_l", "_n")


def group_objects(figures: DataFrame, subfigures: DataFrame, bars: DataFrame, group: str) -> DataFrame:
    """figures with master_images, each with its scale_bars, in order of idx; empty arrays where there are none."""
    bar = F.struct("line_idx", "x1", "y1", "x2", "y2", "length", "distance", "confidence", "label")
    own = bars.groupBy(group, F.col("subfigure_idx").alias("idx")).agg(F.sort_array(F.collect_list(bar)).alias("scale_bars"))
    whole = subfigures.join(own, [group, "idx"], "left")
    record = F.struct("idx", *[c for c in subfigures.columns if c not in (group, "idx")], F.coalesce("scale_bars", F.array().cast(own.schema["scale_bars"].dataType)).alias("scale_bars"))
    nested = whole.groupBy(group).agg(F.sort_array(F.collect_list(record)).alias("master_images"))
    return figures.join(nested, group, "left").withColumn("master_images", F.coalesce("master_images", F.array().cast(nested.schema["master_images"].dataType)))


def figure_key(name: Column) -> Column:
    """`<article>_fig<n>.jpg` -> `<article>-fig<n>`."""
    return F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), "_fig", "-fig")


def class_code(c: Column) -> Column:
    """Code of a class; null for one without."""
    return F.element_at(F.create_map(*(F.lit(x) for kv in CLASS_CODES.items() for x in kv)), c)


def pg_array(c: Column) -> Column:
    """Array literal `{'a', 'b'}` of a text array."""
    return F.concat(F.lit("{"), F.array_join(F.transform(c, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("}"))


def article_table(figures: DataFrame) -> DataFrame:
    """One row an article, from its first figure by name."""
    cols = ["title", "article_url", "license", "open", "authors", "abstract"]
    have = figures.withColumns({c: F.lit("") for c in ("authors", "abstract") if c not in figures.columns})
    first = have.groupBy("article_name").agg(F.min_by(F.struct(*cols), "figure_name").alias("f"))
    return first.select(F.col("article_name").alias("doi"), F.col("f.title").alias("title"), F.col("f.article_url").alias("url"), "f.license", "f.open", "f.authors", "f.abstract")


def figure_table(figures: DataFrame) -> DataFrame:
    """(G5)"""
    return figures.select(figure_key(F.col("figure_name")).alias("figure_id"), F.col("full_caption").alias("caption"), "caption_delimiter", F.col("image_url").alias("url"), F.col("figure_path").alias("path"), F.col("article_name").alias("article_id"))


def _images(figures: DataFrame) -> DataFrame:
    """figure_id, m, subfigure_id: the subfigures of nested figures, or those of images_of() as they are."""
    if "m" in figures.columns:
        return figures
    out = figures.select(figure_key(F.col("figure_name")).alias("figure_id"), F.explode("master_images").alias("m"))
    return out.withColumn("subfigure_id", F.concat_ws("-", "figure_id", "m.label"))


def images_of(figures: DataFrame, subfigures: DataFrame, group: str) -> DataFrame:
    """The subfigures of flat tables, in the form that the table functions take: nothing is nested, so Spark prunes columns and
    pushes filters through."""
    out = subfigures.join(figures.select(group, figure_key(F.col("figure_name")).alias("_key")), group)
    record = F.struct(*[c for c in subfigures.columns if c != group])
    return out.select(F.col("_key").alias("figure_id"), record.alias("m"), F.concat_ws("-", "_key", "label").alias("subfigure_id"))


def bars_of(figures: DataFrame, subfigures: DataFrame, bars: DataFrame, group: str) -> DataFrame:
    """The scale bars of flat tables, numbered within their subfigure, in the form that the table functions take."""
    label = subfigures.select(group, F.col("idx").alias("subfigure_idx"), "label").join(figures.select(group, figure_key(F.col("figure_name")).alias("_key")), group)
    own = F.row_number().over(Window.partitionBy(group, "subfigure_idx").orderBy("line_idx")) - 1
    record = F.struct("line_idx", "x1", "y1", "x2", "y2", "length", "distance", "confidence", "label")
    out = bars.select(group, "subfigure_idx", own.alias("i"), record.alias("b")).join(label, [group, "subfigure_idx"])
    return out.select(F.concat_ws("-", "_key", "label").alias("subfigure_id"), "i", "b").withColumn("scale_bar_id", F.concat_ws("-", "subfigure_id", "i"))


def subfigure_table(figures: DataFrame) -> DataFrame:
    """One row a subfigure; sizes from the box where the record has none."""
    m = F.col("m")
    return _images(figures).select(
        "subfigure_id",
        class_code(m["classification"]).alias("classification_code"),
        F.coalesce(m["height"], (m["y2"] - m["y1"]).cast("double")).alias("height"),
        F.coalesce(m["width"], (m["x2"] - m["x1"]).cast("double")).alias("width"),
        m["nm_height"].alias("nm_height"),
        m["nm_width"].alias("nm_width"),
        *(m[c].alias(c) for c in ("x1", "y1", "x2", "y2")),
        F.array_join(m["caption"], "\t").alias("caption"),
        pg_array(m["keywords"]).alias("keywords"),
        pg_array(m["general"]).alias("general"),
        "figure_id",
    )


def subfigure_label_table(figures: DataFrame) -> DataFrame:
    """Labels that were detected with a box."""
    box = F.col("m.label_box")
    return _images(figures).where(box.isNotNull()).select(F.col("m.label").alias("text"), *(box[c].alias(c) for c in ("x1", "y1", "x2", "y2")), "subfigure_id")


def _bars(figures: DataFrame) -> DataFrame:
    if "b" in figures.columns:
        return figures
    out = _images(figures).select("subfigure_id", F.posexplode("m.scale_bars").alias("i", "b"))
    return out.withColumn("scale_bar_id", F.concat_ws("-", "subfigure_id", "i"))


def scale_bar_table(figures: DataFrame) -> DataFrame:
    """Scale bars, numbered within their subfigure."""
    return _bars(figures).select("scale_bar_id", *(F.col(f"b.{c}").alias(c) for c in ("x1", "y1", "x2", "y2", "length")), F.col("b.distance").alias("line_label_distance"), "b.confidence", "subfigure_id")


def scale_label_table(figures: DataFrame) -> DataFrame:
    """Labels of the scale bars that have one."""
    label = F.col("b.label")
    return _bars(figures).where(label.isNotNull()).select(label["text"].alias("text"), label["label_confidence"].alias("label_confidence"), label["nm"].alias("nm"), "scale_bar_id")


def figure_card(figures: DataFrame) -> DataFrame:
    """Summary text and canvas size of each figure."""
    m = F.col("m")
    text = F.format_string("Subfigure Label: %s\nClassification: %s\nScale Bar Label: %s\nCaption:\n%s", m["label"], m["classification"], F.coalesce(m["scale_label"], F.lit("None")), F.array_join(m["caption"], "\n"))
    rows = _images(figures).select("figure_id", m["idx"].alias("idx"), text.alias("text"), F.coalesce(m["height"], (m["y2"] - m["y1"]).cast("double")).alias("h"), F.coalesce(m["width"], (m["x2"] - m["x1"]).cast("double")).alias("w"))
    return rows.groupBy("figure_id").agg(F.sum(F.col("h") + 150).alias("height"), F.greatest(F.max("w"), F.lit(500.0)).alias("width"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), "\n\n").alias("card"))


def overlay_boxes(figures: DataFrame, loose: DataFrame, kinds: tuple[str, ...] = ("subfigure", "scale_bar", "unassigned")) -> DataFrame:
    """Boxes to draw, of the kinds asked for; loose are scale objects in no subfigure (figure_id, x1..y2)."""
    xy = ("x1", "y1", "x2", "y2")
    parts = [
        _images(figures).select("figure_id", F.lit("subfigure").alias("kind"), *(F.col(f"m.{c}").alias(c) for c in xy)),
        _images(figures).select("figure_id", F.explode("m.scale_bars").alias("b")).select("figure_id", F.lit("scale_bar").alias("kind"), *(F.col(f"b.{c}").alias(c) for c in xy)),
        loose.select("figure_id", F.lit("unassigned").alias("kind"), *xy),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where(F.col("kind").isin(*kinds))


def crop_manifest(images: DataFrame, suffix: str = ".jpg") -> DataFrame:
    """File names of crops. images: figure_root, label, classification, dependents array<struct<classification, insets
    array<struct<classification>>>>, insets array<struct<classification>> (G16)."""

    def code(c):
        return F.lower(F.coalesce(F.left(c, F.lit(3)), F.lit("uas")))

    base = images.withColumn("dir", F.concat_ws("/", "figure_root", "label")).withColumn("stem", F.concat_ws("_", "figure_root", "label"))
    master = base.select("dir", F.concat("stem", F.lit("_"), code(F.col("classification")), F.lit(suffix)).alias("file"))
    dep = base.select("dir", "stem", F.posexplode("dependents").alias("i", "d")).withColumn("dep", F.concat("stem", F.lit("_dep"), F.col("i").cast("string")))
    dependent = dep.select(F.concat("dir", F.lit("/dependent")).alias("dir"), F.concat("dep", F.lit("_"), code(F.col("d.classification")), F.lit(suffix)).alias("file"))
    deep = dep.select("dir", "dep", F.posexplode("d.insets").alias("j", "n")).select(F.concat("dir", F.lit("/dependent/inset")).alias("dir"), F.concat("dep", F.lit("_ins"), F.col("j").cast("string"), F.lit("_"), code(F.col("n.classification")), F.lit(suffix)).alias("file"))
    inset = base.select("dir", "stem", F.posexplode("insets").alias("j", "n")).select(F.concat("dir", F.lit("/inset")).alias("dir"), F.concat("stem", F.lit("_ins"), F.col("j").cast("string"), F.lit("_"), code(F.col("n.classification")), F.lit(suffix)).alias("file"))
    return master.union(dependent).union(deep).union(inset)
