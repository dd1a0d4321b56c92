"""Incremental processing as streams: each run takes what is new, and repeating it changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import first_of


def incoming(spark: SparkSession, folder: str, schema: str, files_at_once: int = 100) -> DataFrame:
    """Parquet files of a folder as they come; those seen before are skipped by the checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def windowed_counts(events: DataFrame, time: str = "ts", by: str = "event_type", late: str = "10 minutes", every: str = "1 hour") -> DataFrame:
    """Events by kind in tumbling windows; what comes later than `late` is dropped, as its window is closed. Counts are combined before the shuffle, so a hot kind is no hot task."""
    return events.withWatermark(time, late).groupBy(F.window(time, every), by).agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), by, "n", "value")


def sessions(events: DataFrame, time: str = "ts", user: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of each user: events of which each comes less than `gap` after the one before it."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), user).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), user, "n")


def run_once(stream: DataFrame, checkpoint: str, name: str | None = None, sink: Callable[[DataFrame, int], None] | None = None, mode: str = "append", path: str | None = None) -> StreamingQuery:
    """Takes all that is there and ends: to a sink of batches, or to parquet files."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.foreachBatch(sink).start() if sink else w.format("parquet").option("path", path).start() if path else w.format("memory").queryName(name).start()
    q.awaitTermination()
    return q


#: Parts of the state; a batch rewrites only those parts whose keys it holds.
PARTS = 64


def _part(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(PARTS)).cast("int")


def _written(spark: SparkSession, folder: str, before: int | None) -> dict[int, str]:
    """For each part of the state the folder that holds its last version, of the batches under `before`. Only names are read. Whatever goes wrong but a missing folder is an error."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    batches = sorted(int(x.getPath().getName()) for x in fs.listStatus(path) if x.getPath().getName().isdigit())
    out: dict[int, str] = {}
    for n in batches:
        if (before is None or n < before) and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS")):
            for x in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}")):
                if (name := x.getPath().getName()).startswith("part_of_state="):
                    out[int(name.split("=")[1])] = f"{folder}/{n}/{name}"
    return out


def current_state(spark: SparkSession, folder: str, before: int | None = None, parts: set[int] | None = None) -> DataFrame | None:
    """The state that upserting has written (before a batch, of some parts); None if there is none."""
    paths = [p for k, p in _written(spark, folder, before).items() if parts is None or k in parts]
    return spark.read.parquet(*sorted(paths)) if paths else None


def upserting(spark: SparkSession, folder: str, key: list[str], *order: str) -> Callable[[DataFrame, int], None]:
    """K5 ST3 ST5 as a sink: of each key the row that is last by `order`, whichever batch brings it. A batch reads and rewrites the parts of the state whose keys it holds, in a folder of its own; a batch that comes again writes the same folder again, from the state before it."""
    last = lambda df: first_of(df, key, *(F.col(c).desc() for c in order))

    def sink(batch: DataFrame, number: int) -> None:
        new = last(batch).withColumn("part_of_state", _part(key)).persist()
        try:
            touched = {r[0] for r in new.select("part_of_state").distinct().collect()}  # PARTS at most
            old = current_state(spark, folder, number, touched) if touched else None
            state = new if old is None else last(new.drop("part_of_state").unionByName(old)).withColumn("part_of_state", _part(key))
            state.write.mode("overwrite").partitionBy("part_of_state").parquet(f"{folder}/{number}")
        finally:
            new.unpersist()

    return sink


def notifying(folder: str, channel: str, *columns: str) -> Callable[[DataFrame, int], None]:
    """K18 ST6 as a sink: a message (channel, payload as JSON) for each row of a batch, in a folder for each batch; a batch that comes again says the same again, under the same number."""

    def sink(batch: DataFrame, number: int) -> None:
        messages = batch.select(F.lit(channel).alias("channel"), F.to_json(F.struct(*columns)).alias("payload"))
        messages.write.mode("overwrite").json(f"{folder}/{number}")

    return sink
