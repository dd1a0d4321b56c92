"""Queries on the readers of vote files, over line items written as rows of such a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import votes as v
from ..tables import load
from . import Registry

query = Registry()


def file_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Strings only, as a file has them: blank codes, unknown votes, sessions that are no numbers, counts with decimals."""
    i = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_quantity")
    vote = F.element_at(F.array(*map(F.lit, ("Y", "N", "A", "X", "Y "))), ((F.col("l_suppkey") + F.col("l_linenumber")) % 5 + 1).cast("int"))
    return i.select(
        F.when(F.col("l_orderkey") % 11 == 0, " ").otherwise((F.col("l_orderkey") % 1000).cast("string")).alias("undl_id"),
        F.concat(F.lit("c"), F.col("l_suppkey") % 60).alias("ms_code"),
        F.when(F.col("l_orderkey") % 1000 < 50, "Y").otherwise(vote).alias("ms_vote"),
        F.when(F.col("l_partkey") % 13 == 0, "no").otherwise((F.col("l_partkey") % 40).cast("string")).alias("session"),
        F.col("l_shipdate").cast("string").alias("date"),
        F.concat(F.lit("A/RES/"), F.col("l_orderkey") % 77, F.lit("/"), F.col("l_orderkey") % 1000).alias("resolution"),
        F.when(F.col("l_linenumber") > 2, F.concat(F.col("l_quantity").cast("int"), F.lit(".0"))).otherwise("n/a").alias("total_yes"),
        F.lit("").alias("total_no"), F.lit("3").alias("total_abstentions"), F.lit(None).cast("string").alias("total_non_voting"), F.lit("193").alias("total_ms"),
        F.concat(F.lit("i"), F.col("l_partkey") % 6).alias("issue"),
        "l_orderkey", "l_linenumber",
    )


_ROWS = """f as (select case when l_orderkey % 11 = 0 then null else cast(l_orderkey % 1000 as varchar) end as event, 'C' || (l_suppkey % 60) as state,
  case when l_orderkey % 1000 < 50 then 'Y' else (['Y', 'N', 'A', 'X', 'Y'])[(l_suppkey + l_linenumber) % 5 + 1] end as code, case when l_partkey % 13 = 0 then null else l_partkey % 40 end as session,
  year(l_shipdate) as year, 'A/RES/' || (l_orderkey % 77) || '/' || (l_orderkey % 1000) as symbol, case when l_linenumber > 2 then cast(l_quantity as int) end as yes, 'i' || (l_partkey % 6) as issue, l_orderkey, l_linenumber from lineitem)"""


@query("file_events", f"with {_ROWS} select event, count(*) as votes, min(state) as first_state from f where event is not null group by 1")
def file_events(spark: SparkSession, sf: str) -> DataFrame:
    """The votes of each event."""
    e = v.events(file_rows(spark, sf))
    return e.select("event", F.size("votes").cast("long").alias("votes"), F.col("votes")[0]["state"].alias("first_state"))


@query("binary_votes", f"with {_ROWS} select year, state, event, count(*) as n, count(*) filter (code = 'Y') as yes from f where event is not null and code in ('Y', 'N') group by all")
def binary_votes(spark: SparkSession, sf: str) -> DataFrame:
    """Votes for and against by year, state and event."""
    return v.binary_votes(file_rows(spark, sf)).groupBy("year", "state", "event").agg(F.count("*").alias("n"), F.count_if("yes").alias("yes"))


@query("ordinal_votes", f"""with {_ROWS}, g as (select event, state, session, case code when 'Y' then 1 when 'A' then 2 when 'N' then 3 end as vote from f where event is not null and code <> 'X' and session is not null and session <> 19)
  select cast(event as varchar) as event, state, cast(session as int) as session, cast(vote as int) as vote, count(*) as n from g where event in (select event from g group by 1 having count(*) >= 5 and min(vote) < max(vote)) group by all""")
def ordinal_votes(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered votes of the events that aren't unanimous."""
    return v.ordinal_votes(file_rows(spark, sf)).groupBy("event", "state", "session", "vote").agg(F.count("*").alias("n"))


_TALLIES = f"{_ROWS}, t as (select event, symbol, yes, row_number() over (partition by event order by l_orderkey, l_linenumber, yes) as r from f where event is not null and yes is not null)"


@query("file_tallies", f"with {_TALLIES}, k as (select event, yes, unnest([symbol, substr(symbol, 7)]) as key from t where r = 1) select key, arg_max(event, event) as event, cast(arg_max(yes, event) as int) as yes from k group by key")
def file_tallies(spark: SparkSession, sf: str) -> DataFrame:
    """The tally of each event by the symbols of its resolution."""
    t = v.tallies(file_rows(spark, sf), F.col("l_orderkey"), F.col("l_linenumber"), F.col("yes"))
    return v.tallies_by_symbol(t).select("key", "event", "yes")


@query("file_issues", f"with {_ROWS} select event, string_agg(distinct issue, ',' order by issue) as issues from f where event is not null group by event")
def file_issues(spark: SparkSession, sf: str) -> DataFrame:
    """The issues of each event."""
    return v.issues(file_rows(spark, sf), "undl_id").select("event", F.concat_ws(",", "issues").alias("issues"))
