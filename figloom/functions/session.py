"""Session helpers: where tables may be cut from their lineage, and how one is written there."""

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; a temporary one only where that is unset and Spark runs
    on one machine (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="figloom-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand Python this many rows at a time at most: texts are long, and so a task's memory stays bounded."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: later steps survive lost executors and start from the files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/figloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def materialise_by(df: DataFrame, column: str) -> DataFrame:
    """The same in a folder for each value of a column, so that discard_part can delete what is read for the last time."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/figloom-{uuid.uuid4().hex}"
    df.write.partitionBy(column).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def append(table: DataFrame, more: DataFrame) -> DataFrame:
    """A table that materialise has written, with further rows written behind its own."""
    more.write.mode("append").parquet(table.stored_at)
    out = table.sparkSession.read.schema(table.schema).parquet(table.stored_at)
    out.stored_at = table.stored_at
    return out


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame | None) -> None:
    """Delete what materialise wrote for these tables; nothing that is still to be computed may read them."""
    for df in tables:
        if (path := getattr(df, "__dict__", {}).pop("stored_at", None)) is not None:
            _delete(df.sparkSession, path)


def discard_part(df: DataFrame, column: str, value) -> None:
    """Delete the rows of one value of a table of materialise_by; what is still to be computed may read the others only."""
    _delete(df.sparkSession, f"{df.stored_at}/{column}={value}")


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage, upon which Spark deletes the shuffle files of steps that are over: first Python's,
    whose frames hold on to the plans of these steps."""
    gc.collect()
    spark._jvm.System.gc()
