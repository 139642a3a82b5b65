"""Structured Streaming over an event table: windows, sessions, deduplication and state by micro-batches.

The reference semantics know no streams; these are the engine's own. ts is
event time; a watermark bounds state. Sources are file streams, so a replay
with availableNow reads all files once and ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.session import shared_dir
from lodestrata.sources.sinks import _fs


def stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """The Parquet files at a path as a stream, ts as an instant."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "*.parquet" if not name.endswith(".parquet") or _is_folder(spark, path) else name).parquet(path if _is_folder(spark, path) else folder)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def tumbling(events: DataFrame, width: str, late: str = "1 day") -> DataFrame:
    """start, event_type, n and total of each window."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select("window.start", "event_type", "n", "total")


def sliding(events: DataFrame, width: str, slide: str, late: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width, slide)).agg(F.count("*").alias("n")).select("window.start", "n")


def sessions(events: DataFrame, gap: str, late: str = "1 day") -> DataFrame:
    """Runs of a user's events of which none is more than the gap after the one before."""
    s = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return s.select("user_id", "session_window.start", "session_window.end", "n")


def deduplicated(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicates(keys)


def replayed(spark: SparkSession, path: str, plan: Callable[[DataFrame], DataFrame], mode: str) -> DataFrame:
    """What a stream over all files at the path comes to: it runs until they are read, and its result is read back."""
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    frame = plan(stream(spark, path))

    def put(batch: DataFrame, number: int) -> None:
        # An epoch that runs again writes the same folder: results are not doubled.
        batch.write.mode("overwrite").parquet(f"{out}/result/{'all' if mode == 'complete' else f'epoch={number}'}")

    q = frame.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{out}/result/all" if mode == "complete" else f"{out}/result/*")


def latest_by_batches(spark: SparkSession, path: str, out: str | None = None) -> DataFrame:
    """event_type, n and last id, merged batch by batch into a table of which each epoch writes a version.

    The last version is found in the store, not remembered, so that a stream
    that starts again from its checkpoint in `out` goes on from it; an epoch
    that runs again builds on the version before its own.
    """
    out = out or f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def version(below: int | None = None) -> str | None:
        fs, p = _fs(spark, f"{out}/versions")
        if not fs.exists(p):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        known = [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit() and fs.exists(_fs(spark, f"{out}/versions/{n}/_SUCCESS")[1])]
        known = [n for n in known if below is None or n < below]
        return f"{out}/versions/v{max(known)}" if known else None

    def put(batch: DataFrame, number: int) -> None:
        new = batch.groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))
        if last := version(number):
            new = new.unionByName(spark.read.parquet(last)).groupBy("event_type").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        new.write.mode("overwrite").parquet(f"{out}/versions/v{number}")

    q = stream(spark, path).writeStream.foreachBatch(put).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(version())
