"""Reading and writing pages, figures, images, tables, documents, annotations and ledgers."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from figloom.operators.geometry import to_box

QUERY_SCHEMA = "name string, journal_family string, maximum_scraped int, sortby string, query map<string, struct<term: string, synonyms: array<string>>>, save_format array<string>, open boolean, logging array<string>"


def read_query(spark: SparkSession, path: str) -> DataFrame:
    """name, field, term of a search configuration: each field's term and its synonyms (A1)."""
    q = spark.read.schema(QUERY_SCHEMA).option("multiLine", True).json(path)
    rows = q.select("name", F.explode("query").alias("field", "t"))
    return rows.select("name", "field", F.explode(F.concat(F.array("t.term"), F.coalesce("t.synonyms", F.array().cast("array<string>")))).alias("term"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages as page_id, url, html (A2)."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def archive_pages(pages: DataFrame, path: str) -> None:
    """Pages as Parquet, by host (A3)."""
    host = F.coalesce(F.regexp_extract("url", "://([^/?#]*)", 1), F.lit(""))
    pages.withColumn("host", host).repartition("host", F.pmod(F.xxhash64("page_id"), F.lit(8))).write.mode("overwrite").partitionBy("host").parquet(path)


def write_figures(figures: DataFrame, path: str) -> None:
    """One JSON record a figure (A5)."""
    figures.write.mode("overwrite").json(path)


def read_figures(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Figures of an earlier run (A4)."""
    return spark.read.schema(schema).json(path)


#: Tasks a core that list folders: else each folder has a task of its own, up to 10,000, which takes longer than to list it.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTED = 4


def read_images(spark: SparkSession, path: str, suffixes: str = "*.{png,jpg,gif}") -> DataFrame:
    """figure_name, length, content of image files."""
    was = spark.conf.get(LISTING)
    spark.conf.set(LISTING, min(int(was), LISTED * spark.sparkContext.defaultParallelism))
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", suffixes).option("recursiveFileLookup", True).load(path)
    finally:
        spark.conf.set(LISTING, was)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("figure_name"), "length", "content")


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Each table as CSV without header."""
    for name, df in tables.items():
        df.write.mode("overwrite").csv(f"{path}/{name}")


def insert_ignore(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """target and the new rows whose key it hasn't, one for each key."""
    return target.unionByName(new.dropDuplicates([key]).join(target.select(key), key, "left_anti"))


def to_documents(df: DataFrame) -> DataFrame:
    """One JSON text a row, as a document store takes it."""
    return df.select(F.to_json(F.struct("*")).alias("document"))


def override(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Both sets; where a key is in both, the second's row (A10)."""
    both = first.withColumn("_o", F.lit(0)).unionByName(second.withColumn("_o", F.lit(1)))
    return both.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_o")))).where("_r = 1").drop("_o", "_r")


#: What an annotated object holds; other keys may come and go.
ANNOTATED = "array<struct<geometry:array<struct<x:double,y:double>>,text:string>>"


def read_annotations(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(figures, rejects) of an annotation set (A10): JSON objects of figure name to {scale_bars, scale_labels}, one or more
    figures a line, or (multi_line) a file.

    Records are read as variants, so keys may differ from figure to figure: what is missing is null, what is more is passed
    over. figures has figure_name, scale_bars, scale_labels; rejects has file, text and reason of lines that are no JSON objects
    and of figures whose objects aren't lists of boxes."""
    lines = spark.read.text(path, wholetext=multi_line).select(F.input_file_name().alias("file"), F.col("value").alias("text"), F.try_parse_json("value").alias("v")).where(F.trim("text") != "")
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    rows = lines.where(is_object).lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("key").alias("figure_name"), F.col("value").alias("record")))
    lists = {k: F.try_variant_get("record", f"$.{k}", ANNOTATED) for k in ("scale_bars", "scale_labels")}
    odd = {k: F.coalesce(F.try_variant_get("record", f"$.{k}", "variant").isNotNull() & ~F.is_variant_null(F.try_variant_get("record", f"$.{k}", "variant")), F.lit(False)) & v.isNull() for k, v in lists.items()}
    told = rows.select("file", "text", "figure_name", *(v.alias(k) for k, v in lists.items()), (odd["scale_bars"] | odd["scale_labels"] | ~F.coalesce(F.schema_of_variant("record").startswith("OBJECT"), F.lit(False))).alias("odd"))
    rejects = lines.where(~is_object).select("file", "text", F.lit("no object").alias("reason")).union(told.where("odd").select("file", F.col("figure_name").alias("text"), F.lit("no list of boxes").alias("reason")))
    return told.where("not odd").select("figure_name", "scale_bars", "scale_labels"), rejects


def annotated_boxes(figures: DataFrame) -> DataFrame:
    """figure_name, category (1 line, 2 label), pos, x1, y1, x2, y2, text: a row an annotated object that has a geometry."""
    one = F.transform("scale_bars", lambda o, i: F.struct(F.lit(1).alias("category"), i.alias("pos"), o["geometry"].alias("g"), o["text"].alias("text")))
    two = F.transform("scale_labels", lambda o, i: F.struct(F.lit(2).alias("category"), i.alias("pos"), o["geometry"].alias("g"), o["text"].alias("text")))
    none = F.array().cast("array<struct<category:int,pos:int,g:array<struct<x:double,y:double>>,text:string>>")
    rows = figures.select("figure_name", F.explode(F.concat(F.coalesce(one, none), F.coalesce(two, none))).alias("o")).where(F.size("o.g") > 0)
    return rows.select("figure_name", "o.category", "o.pos", *to_box(F.col("o.g")), "o.text")


def pending(items: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Items whose key isn't in the ledger yet."""
    return items.join(ledger.select(key).distinct(), key, "left_anti")


def append_done(done: DataFrame, ledger_path: str, key: str) -> None:
    """Adds keys to the ledger, each once."""
    spark = done.sparkSession
    keys = done.select(key).distinct()
    try:
        keys = keys.join(spark.read.schema(keys.schema).parquet(ledger_path), key, "left_anti")
    except Exception as e:  # no ledger yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    keys.write.mode("append").parquet(ledger_path)
