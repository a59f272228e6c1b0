"""Incremental runs: new files in, results and checkpoint out, the same rows as one batch."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _stream(schema: T.StructType, spark: SparkSession, source: str, per_trigger: int) -> DataFrame:
    """Files of a folder, or of the folder that a single file lies in."""
    folder, _, name = source.rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    return reader.option("pathGlobFilter", name).parquet(folder) if _is_file(spark, source) else reader.parquet(source)


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


#: State lies in an embedded store on disk, so that a task's memory doesn't grow with the keys seen.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def _once(rows: DataFrame, keys: list[str], time: str | None, within: str | None) -> DataFrame:
    """Each key once; where a time and a delay are told, a key is forgotten when the newest row is later than its own by more
    than the delay, so that the state is as large as the keys of that span."""
    if not time:
        return rows.dropDuplicates(keys)
    return rows.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)


def _run(rows: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Writes what is new under sink until all files that have come are done; the table, with the run's progress reports."""
    spark = rows.sparkSession
    was = {k: spark.conf.get(k, None) for k in STATE_STORE}
    try:
        for k, v in STATE_STORE.items():
            spark.conf.set(k, v)
        run = rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        run.awaitTermination()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(rows.schema).parquet(sink)
    out.progress = [p for p in run.recentProgress if p["stateOperators"]]
    return out


def stream_run(schema: T.StructType, spark: SparkSession, source: str, stage, sink: str, checkpoint: str, key: str, per_trigger: int = 4, time: str | None = None, within: str | None = None) -> DataFrame:
    """What the stage makes of all files that have come, appended under `sink` with each key once; restartable.

    The keys seen are the stream's state, so a run of new files reads nothing of what was written before. With a column of
    time and a delay, keys are forgotten after it."""
    return _run(_once(stage(_stream(schema, spark, source, per_trigger)), [key], time, within), sink, checkpoint)


def stream_distinct(schema: T.StructType, spark: SparkSession, source: str, keys: list[str], sink: str, checkpoint: str, per_trigger: int = 4, time: str | None = None, within: str | None = None) -> DataFrame:
    """Different keys of all files that have come; the seen ones are the stream's state, with a time and a delay those of this
    span alone (J2)."""
    rows = _stream(schema, spark, source, per_trigger).select(*keys, *([time] if time and time not in keys else []))
    return _run(_once(rows, keys, time, within), sink, checkpoint).select(*map(F.col, keys))
