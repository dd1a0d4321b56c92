"""Pairwise agreement of the members of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pairs_in_group(rows: DataFrame, group: list[str], member: str, value: str | None = None) -> DataFrame:
    """All pairs a < b of the distinct members of each group (with both values), from one aggregation instead of a self-join.

    A group is the set of states in one vote, or of sponsors of one text: its size is bounded by the number of states (about 200), not by the data.
    """
    one = F.struct(F.col(member).alias("m"), F.col(value).alias("v")) if value else F.struct(F.col(member).alias("m"))
    groups = rows.where(F.col(member).isNotNull()).groupBy(*group).agg(F.sort_array(F.collect_set(one)).alias("all"))
    tails = groups.select(*group, F.col("all"), F.posexplode("all").alias("i", "x")).where(F.col("i") < F.size("all") - 1)
    ends = tails.select(*group, "x", F.explode(F.expr("slice(all, i + 2, size(all))")).alias("y"))
    out = [F.col("x.m").alias("a"), F.col("y.m").alias("b")] + ([F.col("x.v").alias("va"), F.col("y.v").alias("vb")] if value else [])
    return ends.select(*group, *out).where(F.col("a") < F.col("b"))


def agreement(ballots: DataFrame, period: str = "yr", vote: str = "vote_id", member: str = "country_id", position: str = "vote_position", least: int = 10) -> DataFrame:
    """country_id_a < country_id_b, period, agreement_rate and n_votes of all pairs with `least` common votes or more; yes, no and abstain count, anything else is no vote."""
    cast = ballots.where(F.col(position).isin("yes", "no", "abstain"))
    p = pairs_in_group(cast, [vote, period], member, position)
    agg = p.groupBy(F.col("a").alias("country_id_a"), F.col("b").alias("country_id_b"), period).agg(F.avg(F.when(F.col("va") == F.col("vb"), 1.0).otherwise(0.0)).alias("agreement_rate"), F.count("*").alias("n_votes"))
    return agg.where(F.col("n_votes") >= least)
