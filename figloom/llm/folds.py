"""Which rows a model may learn from, told by a checksum of the id."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(folds: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
