"""Queries on order-dependent behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import sequences as ops
from ..operators.ballots import BALLOTS_SQL, ballots
from ..tables import load
from . import Registry

query = Registry()


def spoken(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "speeches").select("id", "document_id", "position_in_document", F.col("position_in_item").alias("pii"), "speech_type", "speaker.name", "text")


_ORDER = "order by position_in_document, id"


@query("item_counter", f"select id, row_number() over (partition by document_id {_ORDER}) - 1 as position_in_document, row_number() over (partition by document_id, speech_type {_ORDER}) - 1 as position_in_item from speeches")
def item_counter(spark: SparkSession, sf: str) -> DataFrame:
    """W1."""
    s = spoken(spark, sf).withColumnRenamed("position_in_document", "pos")
    out = ops.counters(s, ["document_id"], ["speech_type"], ["pos", "id"])
    return out.select("id", F.col("position_in_document").cast("long"), F.col("position_in_item").cast("long"))


@query("section_ids", f"select id, cast(sum(case when lower(speaker.name) like 'the %' then 1 else 0 end) over (partition by document_id {_ORDER}) as bigint) as section_id from speeches")
def section_ids(spark: SparkSession, sf: str) -> DataFrame:
    """A section begins where an office speaks."""
    return ops.sections(spoken(spark, sf), ["document_id"], ["position_in_document", "id"], F.lower("name").like("the %")).select("id", "section_id")


@query("lookback_context", f"select id, array_to_string(list(cast(id as varchar)) over (partition by document_id {_ORDER} rows between 5 preceding and 1 preceding), ',') as context from speeches")
def lookback_context(spark: SparkSession, sf: str) -> DataFrame:
    """The five speeches before."""
    s = ops.look_back(spoken(spark, sf).withColumn("me", F.col("id").cast("string")), ["document_id"], ["position_in_document", "id"], "me", 5, "seen")
    return s.select("id", F.when(F.size("seen") > 0, F.array_join("seen", ",")).alias("context"))


@query("last_header", f"select id, last_value(case when speech_type = 'explanation_of_vote' then id end ignore nulls) over (partition by document_id {_ORDER} rows between unbounded preceding and current row) as header from speeches")
def last_header(spark: SparkSession, sf: str) -> DataFrame:
    """W6."""
    return ops.last_seen(spoken(spark, sf), ["document_id"], ["position_in_document", "id"], F.when(F.col("speech_type") == "explanation_of_vote", F.col("id")), "header").select("id", "header")


@query("smooth_vector", f"with {BALLOTS_SQL}, n as (select country_id, yr, count(*) as n from ballots group by all) select country_id, yr, round(coalesce(n / (n + coalesce(lag(n) over w, lead(n) over w)), 1.0e0), 6) as smooth from n window w as (partition by country_id order by yr)")
def smooth_vector(spark: SparkSession, sf: str) -> DataFrame:
    """W4 ML4."""
    n = ballots(spark, sf).groupBy("country_id", "yr").agg(F.count("*").alias("n"))
    return ops.smooth(n, "country_id", "yr", "n").select("country_id", "yr", F.round("smooth", 6).alias("smooth"))


@query(
    "first_seen_speaker",
    """with f as (select speaker.name as name, min(d.date) as first_seen, max(d.date) as last_seen from speeches s join documents d on d.doc_id = s.document_id group by 1)
  select name, cast(first_seen as varchar) as first_seen, date_diff('day', first_seen, last_seen) / 365.25e0 > 15 as may_be_two from f""",
)
def first_seen_speaker(spark: SparkSession, sf: str) -> DataFrame:
    """When a name comes first, and whether it spans more than 15 years."""
    d = load(spark, sf, "documents", "doc_id", "date")
    s = load(spark, sf, "speeches").select("speaker.name", F.col("document_id").alias("doc_id")).join(d, "doc_id")
    f = s.groupBy("name").agg(F.min("date").alias("first_seen"), F.max("date").alias("last_seen"))
    return f.select("name", F.col("first_seen").cast("string").alias("first_seen"), (F.datediff("last_seen", "first_seen") / 365.25 > 15).alias("may_be_two"))


@query(
    "meeting_replay",
    """select document_id, kind, ref, row_number() over (partition by document_id order by position, kind, ref) - 1 as place from (
  select document_id, 'speech' as kind, id as ref, position_in_document as position from speeches
  union all select s.document_id, 'mention', m.id, s.position_in_document from speech_resolution_mentions m join speeches s on s.id = m.speech_id)""",
)
def meeting_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Elements of several kinds in one order."""
    s = load(spark, sf, "speeches", "id", "document_id", "position_in_document")
    m = load(spark, sf, "speech_resolution_mentions", "id", "speech_id").withColumnRenamed("id", "ref").join(s.withColumnRenamed("id", "speech_id"), "speech_id")
    rows = s.select("document_id", F.lit("speech").alias("kind"), F.col("id").alias("ref"), F.col("position_in_document").alias("position")).unionByName(m.select("document_id", F.lit("mention").alias("kind"), "ref", F.col("position_in_document").alias("position")))
    return rows.select("document_id", "kind", "ref", (F.row_number().over(W.partitionBy("document_id").orderBy("position", "kind", "ref")) - 1).cast("long").alias("place"))


@query("time_split", f"with {BALLOTS_SQL}, y as (select yr, row_number() over (order by yr) - 1 as k, count(*) over () as n from (select distinct yr from ballots)) select yr, k < floor(0.8e0 * n) as trains from y")
def time_split(spark: SparkSession, sf: str) -> DataFrame:
    """W12 ML11: the first four fifths of the years train. The window runs over the distinct years, a handful."""
    y = load(spark, sf, "lineitem", "l_shipdate").select(F.year("l_shipdate").alias("yr")).distinct()
    n = y.agg(F.count("*").alias("n"))
    return y.withColumn("k", F.row_number().over(W.orderBy("yr")) - 1).crossJoin(F.broadcast(n)).select("yr", (F.col("k") < F.floor(0.8 * F.col("n"))).alias("trains"))
