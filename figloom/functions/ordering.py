"""Rows in order over many partitions, and where each partition's part of a group begins."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from figloom.functions.session import materialise


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """df range-partitioned and sorted by order, with _part and _row (its place in the partition), as a written table: a group
    of very many rows is several partitions, and the places stay what they are if a task is run again."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialise(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_part"), row.alias("_row")))


def earlier(name: str):
    """The window of a group's earlier partitions, over one row a group and partition."""
    return Window.partitionBy(name).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
