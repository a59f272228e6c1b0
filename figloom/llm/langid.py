"""Language identification by compression.

A language's model is the raw text of some of its documents, used as a zstandard dictionary. A text is cut into blocks,
every block is compressed with each dictionary, and the language with the smallest sum wins. Where the best two are
within a narrow margin the answer is marked as rejected.

Fitting takes a bounded sample: of each language `sample_docs` different texts by the order of a hash, and of each a piece
at a hashed place, all of one size, `dict_bytes` in all; the counts that it is drawn by cover all labelled rows. All
languages are learned, and their dictionaries are tried BLOCK_LANGUAGES at a time. Predictions read every whole text.

Null texts and texts without a letter are `und` with score 0; nothing learned makes every text `und`; ties go to the
language with more labelled documents, then by name. Texts may be of any length; an empty table gives an empty result.
Repeated rows, null ids and other columns, whatever their names, make no difference.
"""

import pickle
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Bytes of normalised text that are compressed at a time, so that the dictionary and not the text itself is matched.
BLOCK_BYTES = 1000
#: Characters of a sampled text.
PIECE = 1000
#: The best two sizes are a narrow margin apart if the second is less than this share larger.
NARROW = 0.01
#: Dictionaries that are held ready at a time.
BLOCK_LANGUAGES = 200
_NO_LETTERS = regex.compile(r"\P{L}+")


def normalise(text: str) -> bytes:
    """Lower case, with one space for each run of other characters than letters."""
    return _NO_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def fit(labelled: DataFrame, sample_docs: int = 400, dict_bytes: int = 48_000) -> list[tuple[str, bytes]]:
    """(language, dictionary) pairs, the language with most documents first; labelled has doc_id, text and lang."""
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return []
    spark = labelled.sparkSession
    # A hash below 4 x sample / count leaves about 4 samples a language, so the ranking never sees all of one language.
    shares = spark.createDataFrame([(r["lang"], min(1.0, 4.0 * sample_docs / r["count"] + 64 / r["count"])) for r in counts], "lang string, share double")
    h = F.xxhash64("text")
    some = rows.join(F.broadcast(shares), "lang").where(F.pmod(h, F.lit(1_000_003)) < F.col("share") * 1_000_003)
    # Of a text of more than a piece, what begins at a hashed place; all of a shorter one.
    start = F.pmod(F.shiftrightunsigned(h, 20), F.greatest(F.length("text") - F.lit(PIECE) + 1, F.lit(1))) + 1
    some = some.select("lang", h.alias("h"), F.substring("text", start.cast("int"), F.lit(PIECE)).alias("piece")).dropDuplicates(["lang", "h"])
    picked = some.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "piece"))).where(F.col("r") <= sample_docs)
    pieces: dict[str, list[bytes]] = {}
    for r in picked.orderBy("lang", "r").collect():
        pieces.setdefault(r["lang"], []).append(normalise(r["piece"]))
    return [(r["lang"], _shared_out(pieces.get(r["lang"], []), dict_bytes)) for r in counts]


def _shared_out(pieces: list[bytes], most: int) -> bytes:
    """The pieces joined, of each as much as an equal share of what the shorter ones leave."""
    out, left = [], most
    for k, piece in enumerate(sorted(pieces, key=len)):
        out.append(piece[: left // (len(pieces) - k)])
        left -= len(out[-1])
    return b" ".join(out)[:most]


@lru_cache(2)
def _compressors(models: bytes, level: int):
    out = []
    for lang, content in pickle.loads(models):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(level, source_size=BLOCK_BYTES, dict_size=len(content), min_match=3, write_content_size=False, write_dict_id=False)
        d.precompute_compress(compression_params=params)
        out.append((lang, zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress))
    return out


def sizes_of(text: str | None, compressors) -> list[int] | None:
    """Compressed sizes of one text by each dictionary; None for one without a letter."""
    letters = normalise(text or "")
    if not letters:
        return None
    blocks = [letters[i : i + BLOCK_BYTES] for i in range(0, len(letters), BLOCK_BYTES)]
    return [sum([len(compress(b)) for b in blocks]) for _, compress in compressors]


def judge(sizes: list[int] | None, languages: list[str]) -> tuple[str, float, bool]:
    """(language or und, score from 0 to 1, rejected) by the sizes of one text."""
    if not sizes:
        return "und", 0.0, True
    sizes = np.array(sizes, float)
    best = int(sizes.argmin())
    gain = np.partition(sizes, 1)[1] / sizes[best] - 1 if len(sizes) > 1 else 1.0
    return languages[best], float(1 - 1 / (1 + gain / NARROW)), bool(gain < NARROW)


def predict(docs: DataFrame, models: list[tuple[str, bytes]], level: int = 7) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row; a model is of bounded size, so all are broadcast."""
    blocks = [pickle.dumps(models[i : i + BLOCK_LANGUAGES]) for i in range(0, len(models), BLOCK_LANGUAGES)]
    languages = [lang for lang, _ in models]
    shared = docs.sparkSession.sparkContext.broadcast(blocks)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = part.column(1).to_pylist()
                sizes: list = [[] for _ in texts]
                for block in shared.value:
                    compressors = _compressors(block, level)
                    sizes = [None if old is None or (new := sizes_of(t, compressors)) is None else old + new for old, t in zip(sizes, texts, strict=True)]
                found = [judge(x, languages) for x in sizes]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
