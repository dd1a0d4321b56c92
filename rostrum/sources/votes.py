"""Readers of vote files: rows of strings, one for each state and event, to typed votes, tallies and issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators.upsert import first_of

# Codes of votes and their order, the session that had one vote only, and the least votes of an event.
ORDER = {"Y": 1, "A": 2, "N": 3}
LONE_SESSION, LEAST_VOTES = 19, 5
#: Half of a 90 per cent interval in standard errors (fixed value).
HALF_INTERVAL = 1.645


def whole_number(c: Column) -> Column:
    """M6: the whole part of a number that may be written with decimals; null if it is none."""
    return F.trim(c).try_cast("double").try_cast("int")


def filled(c: str) -> Column:
    return t.blank_to_null(F.col(c))


def events(rows: DataFrame, event: str = "undl_id", state: str = "ms_code", vote: str = "ms_vote") -> DataFrame:
    """Event, votes (state, vote) for each event, sorted; rows without event or state are left out. An event has as many votes as there are states."""
    good = rows.select(filled(event).alias("event"), F.upper(filled(state)).alias("state"), F.upper(filled(vote)).alias("vote")).where(F.col("event").isNotNull() & F.col("state").isNotNull())
    return good.groupBy("event").agg(F.sort_array(F.collect_list(F.struct("state", "vote"))).alias("votes"))


def binary_votes(rows: DataFrame) -> DataFrame:
    """Year, state, event, yes of the votes for and against; the year is that of the first four characters of the date."""
    out = rows.select(F.substring(filled("date"), 1, 4).try_cast("int").alias("year"), F.upper(filled("ms_code")).alias("state"), filled("undl_id").alias("event"), F.trim("ms_vote").alias("vote"))
    return out.where(F.col("vote").isin("Y", "N") & F.col("year").isNotNull() & F.col("state").isNotNull() & F.col("event").isNotNull()).select("year", "state", "event", (F.col("vote") == "Y").alias("yes"))


def ordinal_votes(rows: DataFrame, least: int = LEAST_VOTES) -> DataFrame:
    """Event, state, session, vote (1 yes, 2 abstention, 3 no) of the events with `least` votes or more that aren't unanimous; LONE_SESSION is left out. Counted over each event, without a join."""
    vote = F.coalesce(*(F.when(F.trim("ms_vote") == k, n) for k, n in ORDER.items()))
    typed = rows.select(filled("undl_id").alias("event"), F.upper(filled("ms_code")).alias("state"), F.when(F.trim("session").rlike(r"^\d+$"), F.trim("session").try_cast("int")).alias("session"), vote.alias("vote"))
    typed = typed.where("event is not null and state is not null and vote is not null and session is not null").where(F.col("session") != LONE_SESSION)
    kept = typed.groupBy("event").agg(F.count("*").alias("n"), F.min("vote").alias("lo"), F.max("vote").alias("hi")).where((F.col("n") >= least) & (F.col("lo") < F.col("hi"))).select("event")
    return typed.join(kept, "event", "left_semi")


COUNTS = {"yes": "total_yes", "no": "total_no", "abstain": "total_abstentions", "non_voting": "total_non_voting", "members": "total_ms"}


def tallies(rows: DataFrame, *order: Column) -> DataFrame:
    """Event, resolution and its counts, of the first row by `order` that counts yes or no, for each event."""
    typed = rows.select("*", filled("undl_id").alias("event"), filled("resolution").alias("symbol"), *(whole_number(F.col(c)).alias(n) for n, c in COUNTS.items())).where("event is not null and (yes is not null or no is not null)")
    return first_of(typed, ["event"], *order).select("event", "symbol", *COUNTS)


def tallies_by_symbol(tallied: DataFrame) -> DataFrame:
    """A row for each way of writing a resolution's symbol, long and short; of several events of one symbol the last."""
    keys = F.array_distinct(F.array(F.col("symbol"), F.regexp_replace("symbol", "^A/RES/", "")))
    each = tallied.where(F.col("symbol").isNotNull()).select(F.explode(keys).alias("key"), "event", *COUNTS)
    return each.withColumn("_r", F.row_number().over(W.partitionBy("key").orderBy(F.desc("event")))).where("_r = 1").drop("_r")


def issues(rows: DataFrame, event: str = "rcid", issue: str = "issue") -> DataFrame:
    """Event, issues (the set of its issue codes, sorted)."""
    good = rows.select(filled(event).alias("event"), filled(issue).alias("issue")).where("event is not null and issue is not null")
    return good.groupBy("event").agg(F.sort_array(F.collect_set("issue")).alias("issues"))


def standard_error(low: Column, high: Column) -> Column:
    """Of an estimate whose 90 per cent interval is known."""
    return (high - low) / (2 * HALF_INTERVAL)
