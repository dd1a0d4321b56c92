"""Queries on streams: the events table as a stream that takes what is there and ends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import shared_folder
from ..streaming import incremental as s
from ..tables import load
from . import Registry

query = Registry()


def _events(spark: SparkSession, sf: str) -> DataFrame:
    table = load(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    return spark.readStream.schema(table.schema).parquet(f"{sf}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


def _to_memory(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    name = f"stream_{uuid.uuid4().hex[:12]}"
    folder = f"{shared_folder(spark)}/{name}"
    if mode == "append":
        s.run_once(stream, f"{folder}/checkpoint", path=f"{folder}/out")
        return spark.read.parquet(f"{folder}/out")
    s.run_once(stream, f"{folder}/checkpoint", sink=lambda b, _: b.write.mode("overwrite").parquet(f"{folder}/out"), mode=mode)
    return spark.read.parquet(f"{folder}/out")


@query("stream_windows", "select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n, round(sum(value), 4) as value from events group by all")
def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Tumbling windows over a stream, complete state."""
    return _to_memory(spark, s.windowed_counts(_events(spark, sf)), "complete").withColumn("value", F.round("value", 4))


@query("stream_closed_windows", "select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events where time_bucket(interval '1 hour', ts) + interval '1 hour' <= (select max(ts) from events) - interval '10 minutes' group by all")
def stream_closed_windows(spark: SparkSession, sf: str) -> DataFrame:
    """ST1: windows that the watermark has closed; only these are given out, and their state is freed."""
    return _to_memory(spark, s.windowed_counts(_events(spark, sf)).drop("value"), "append")


@query("stream_sessions", """with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval '30 minutes' then 0 else 1 end as begins from events),
  g as (select user_id, ts, sum(begins) over (partition by user_id order by ts rows unbounded preceding) as k from e)
  select min(ts) as start, max(ts) + interval '30 minutes' as "end", user_id, count(*) as n from g group by user_id, k""")
def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """ST2: sessions of each user over a stream."""
    return _to_memory(spark, s.sessions(_events(spark, sf)), "complete")


@query("stream_notices", "select 'vetoes' as channel, dppa_id from vetoes")
def stream_notices(spark: SparkSession, sf: str) -> DataFrame:
    """K18 ST6: a message for each row that comes."""
    folder = f"{shared_folder(spark)}/notices_{uuid.uuid4().hex[:12]}"
    rows = load(spark, sf, "vetoes", "dppa_id", "date")
    s.run_once(spark.readStream.schema(rows.schema).parquet(f"{sf}/vetoes.parquet*"), f"{folder}/checkpoint", sink=s.notifying(f"{folder}/out", "vetoes", "dppa_id", "date"))
    return spark.read.schema("channel string, payload string").json(f"{folder}/out/*").select("channel", F.get_json_object("payload", "$.dppa_id").cast("long").alias("dppa_id"))


@query("stream_upsert", "select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as r from events) where r = 1")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """K5 as a stream: the last event of each user and kind."""
    folder = f"{shared_folder(spark)}/upsert_{uuid.uuid4().hex[:12]}"
    s.run_once(_events(spark, sf), f"{folder}/checkpoint", sink=s.upserting(spark, f"{folder}/state", ["user_id", "event_type"], "ts", "event_id"))
    return s.current_state(spark, f"{folder}/state").select("user_id", "event_type", "event_id")
