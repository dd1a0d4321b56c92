"""Views of the order tables in the shape of roll calls: who voted how, and who sponsored what."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import load

#: How a return flag reads as a vote.
POSITION = "case l_returnflag when 'N' then 'yes' when 'R' then 'no' else 'abstain' end"


def ballots(spark: SparkSession, sf: str) -> DataFrame:
    """country_id, vote_id, yr, vote_position: one ballot for each country, vote and year; of several the first in alphabetical order.

    Rows are partitioned by (vote_id, yr) before the aggregation, so that everything that works on one vote afterwards needs no further shuffle.
    """
    l = load(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey")
    c = load(spark, sf, "customer", "c_custkey", "c_nationkey")
    rows = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select(F.col("c_nationkey").alias("country_id"), F.col("l_partkey").alias("vote_id"), F.year("l_shipdate").alias("yr"), F.expr(POSITION).alias("vote_position"))
    return rows.repartition("vote_id", "yr").groupBy("country_id", "vote_id", "yr").agg(F.min("vote_position").alias("vote_position"))


def sponsors(spark: SparkSession, sf: str) -> DataFrame:
    """resolution_id, country_id, yr: the distinct sponsors of each resolution."""
    l = load(spark, sf, "lineitem", "l_orderkey", "l_suppkey")
    o = load(spark, sf, "orders", "o_orderkey", "o_orderdate")
    s = load(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    rows = l.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(F.col("o_orderkey").alias("resolution_id"), F.col("s_nationkey").alias("country_id"), F.year("o_orderdate").alias("yr")).distinct()


BALLOTS_SQL = f"""ballots as (
  select c_nationkey as country_id, l_partkey as vote_id, cast(year(l_shipdate) as int) as yr, min({POSITION}) as vote_position
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by all)"""

SPONSORS_SQL = """sponsors as (
  select distinct o_orderkey as resolution_id, s_nationkey as country_id, cast(year(o_orderdate) as int) as yr
  from lineitem join supplier on l_suppkey = s_suppkey join orders on l_orderkey = o_orderkey)"""
