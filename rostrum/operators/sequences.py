"""Order-dependent behaviour as windows: counters, sections, look-back, neighbours in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def counters(df: DataFrame, outer: list[str], inner: list[str], order: list[str]) -> DataFrame:
    """position_in_document and position_in_item, from 0; all kinds of elements share the counters."""
    return df.withColumn("position_in_document", F.row_number().over(W.partitionBy(*outer).orderBy(*order)) - 1).withColumn("position_in_item", F.row_number().over(W.partitionBy(*outer, *inner).orderBy(*order)) - 1)


def sections(df: DataFrame, group: list[str], order: list[str], starts: Column) -> DataFrame:
    """section_id, which grows by one with every row that starts a section."""
    w = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("section_id", F.sum(F.when(starts, 1).otherwise(0)).over(w))


def look_back(df: DataFrame, group: list[str], order: list[str], column: str, rows: int, name: str) -> DataFrame:
    """The values of the last `rows` rows before."""
    return df.withColumn(name, F.collect_list(column).over(W.partitionBy(*group).orderBy(*order).rowsBetween(-rows, -1)))


def last_seen(df: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The last value that wasn't null, forgotten at the end of a group."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def smooth(df: DataFrame, member: str, period: str, n: str) -> DataFrame:
    """W4 ML4: n / (n + that of the period before with data, or else of the one after), 1 if there is neither."""
    w = W.partitionBy(member).orderBy(period)
    near = F.coalesce(F.lag(n).over(w), F.lead(n).over(w))
    return df.withColumn("smooth", F.coalesce(F.col(n) / (F.col(n) + near), F.lit(1.0)))
