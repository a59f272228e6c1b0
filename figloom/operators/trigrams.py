"""A stored index of character trigrams, so that a search for a piece of text reads few files.

Two tables lie under the index's path: the texts themselves (id, text), dealt to folders by a hash of the id and within
these to blocks of about BLOCK texts, and postings (gram, block), dealt to folders by a hash of the gram and sorted by it.
A gram that most texts have is so one row a block and not one a text, and the index is about as large as the texts. A
search counts the postings of its grams, takes the blocks that hold the rarest of them, reads these blocks from their
folders, and compares the text itself. Several pieces are looked for in one pass over the texts. Case is ignored. What is
shorter than three characters has no gram and is looked for in all texts.

Null texts are in no index; ids that occur with several texts are found by any of them."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figloom.operators.patterns import with_held

GRAM = 3
#: Folders of postings and of texts.
BUCKETS = 256
#: Grams whose postings are intersected: more make fewer candidates and more reading.
RAREST = 3
#: Texts of a block.
BLOCK = 256
#: Blocks up to this many are broadcast to the texts.
BROADCAST_IDS = 500_000


@dataclass
class TextIndex:
    path: str
    spark: SparkSession
    id_type: str
    buckets: int

    def _table(self, name: str) -> DataFrame:
        columns = {"postings": "gram string, block long, bucket int", "texts": f"id {self.id_type}, text string, block long, part int"}
        return self.spark.read.schema(columns[name]).parquet(f"{self.path}/{name}")

    def _postings(self, grams: list[str]) -> DataFrame:
        """The postings of these grams: only their folders are read."""
        one = self.spark.range(1).select(F.explode(F.array(*map(F.lit, grams))).alias("gram"))
        folders = sorted({r[0] for r in one.select(_bucket("gram", self.buckets)).collect()})
        return self._table("postings").where(F.col("bucket").isin(folders) & F.col("gram").isin(grams))

    def holding(self, piece: str) -> DataFrame:
        """id of every text that holds the piece, each once."""
        piece = piece.lower()
        grams = _grams(piece)
        texts = self._table("texts")
        if grams:
            counts = {r["gram"]: r["n"] for r in self._postings(grams).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}
            rarest = sorted(grams, key=lambda g: (counts.get(g, 0), g))[:RAREST]
            blocks = self._postings(rarest).groupBy("block").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(rarest)).select("block")
            # What lies in these folders at most: as many blocks as the rarest gram has postings.
            few = min(counts.get(g, 0) for g in rarest) <= BROADCAST_IDS
            folders = sorted(r[0] for r in blocks.select(_part_of("block", self.buckets).alias("part")).distinct().collect())
            texts = texts.where(F.col("part").isin(folders)).join(F.broadcast(blocks) if few else blocks, "block", "left_semi")
        return texts.where(F.contains("text", F.lit(piece))).select("id").distinct()

    def holding_each(self, pieces: list[str]) -> DataFrame:
        """id, piece (as given) of every text that holds it, each pair once, for any number of pieces in one pass: the blocks
        that hold the rarest grams of a piece are read once, and each text is scanned for all pieces at once."""
        plain = {p for p in pieces if p is not None}
        grams = {p: _grams(p.lower()) for p in plain}
        every = sorted({g for x in grams.values() for g in x})
        texts = self._table("texts")
        if every and all(grams.values()):
            counts = {r["gram"]: r["n"] for r in self._postings(every).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}
            rarest = {tuple(sorted(sorted(g, key=lambda x: (counts.get(x, 0), x))[:RAREST])) for g in grams.values()}
            wanted = self.spark.createDataFrame([(k, g, len(x)) for k, x in enumerate(sorted(rarest)) for g in x], "k long, gram string, of int")
            held = self._postings(sorted({g for x in rarest for g in x})).join(F.broadcast(wanted), "gram")
            blocks = held.groupBy("block", "k").agg(F.count_distinct("gram").alias("n"), F.min("of").alias("of")).where("n = of").select("block").distinct()
            few = sum(min(counts.get(g, 0) for g in x) for x in rarest) <= BROADCAST_IDS
            folders = sorted(r[0] for r in blocks.select(_part_of("block", self.buckets).alias("part")).distinct().collect())
            texts = texts.where(F.col("part").isin(folders)).join(F.broadcast(blocks) if few else blocks, "block", "left_semi")
        told = self.spark.createDataFrame([(p.lower(), p) for p in sorted(plain)], "pattern string, label string")
        found = with_held(texts.select("id", "text"), "text", told, "_held")
        always = F.array(*(F.lit(p) for p in sorted(plain) if not p)).cast("array<string>")
        return found.select("id", F.explode(F.array_union("_held", always)).alias("piece")).distinct()


def _grams(piece: str) -> list[str]:
    return sorted({piece[i : i + GRAM] for i in range(len(piece) - GRAM + 1)})


def _bucket(column: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(column)), F.lit(buckets)).cast("int")


def _part_of(block: str, buckets: int):
    """The folder of a block: blocks are numbered so that its number tells it."""
    return F.pmod(F.col(block), F.lit(buckets)).cast("int")


def build(rows: DataFrame, id_col: str, text_col: str, path: str, buckets: int = BUCKETS) -> TextIndex:
    """Writes the index of a table under path: the texts first, from which the postings are made a file at a time, so that
    few of a block's grams travel twice."""
    texts = rows.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.lower(text_col).alias("text"))
    blocks = buckets * max(1, -(-texts.count() // (BLOCK * buckets)))
    texts = texts.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    dealt = texts.withColumn("part", _part_of("block", buckets)).repartition("part", F.floor(F.col("block") / buckets) % 8)
    dealt.sortWithinPartitions("part", "block").write.partitionBy("part").parquet(f"{path}/texts")
    index = TextIndex(path, rows.sparkSession, rows.schema[id_col].dataType.simpleString(), buckets)
    grams = F.array_distinct(F.regexp_extract_all("text", F.lit(rf"(?s)(?=(.{{{GRAM}}}))."), F.lit(1)))
    postings = index._table("texts").select("block", F.explode(grams).alias("gram")).distinct().withColumn("bucket", _bucket("gram", buckets))
    postings.repartition("bucket", F.col("block") % 8).sortWithinPartitions("bucket", "gram", "block").write.partitionBy("bucket").parquet(f"{path}/postings")
    return index


def open_index(spark: SparkSession, path: str, id_type: str = "string", buckets: int = BUCKETS) -> TextIndex:
    """An index that build has written, of ids of this type and as many buckets."""
    return TextIndex(path, spark, id_type, buckets)
