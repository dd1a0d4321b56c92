"""What the operators need from the session: a shared folder for lineage cuts, and joins that stand hot keys."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than this share of the rows of a table is hot; there are fewer than 1 / HOT_SHARE of them, however large the table.
HOT_SHARE = 1 / 64


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only in local mode, where executors are threads of the driver, one is made here if that is unset; a cluster needs the setting."""
    sc = spark.sparkContext
    if (known := sc.getCheckpointDir()) is not None:
        return known
    if not (folder := spark.conf.get("spark.checkpoint.dir", None)):
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="rostrum-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it from there: later steps neither run it again nor carry its plan, and lost executors take nothing with them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def held(df: DataFrame) -> DataFrame:
    """cut(df), which joins by sorting: for tables that grow with the data and are joined many times, where a broadcast of each would pile up in the driver's memory."""
    return cut(df).hint("merge")


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """The values of `key` that hold more than `share` of the rows with a key. At most 1 / share values come to the driver; the counts are combined before they are shuffled."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    hot = counts.crossJoin(F.broadcast(total)).where(F.col("n") > F.col("t") * F.lit(share))  # total is a single row
    return [r[0] for r in hot.select(key).collect()]


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "left", share: float = HOT_SHARE) -> DataFrame:
    """Equi-join where some keys may hold a third of `left`; `right` must have one row for each key (aggregate it by the key first). `left` is read three times: cut it before, where it is more than a scan.

    Rows of hot keys meet the few right rows of these keys (fewer than 1 / share) by broadcast and are not shuffled; all others take part in the usual join. No row is dropped or sampled.
    """
    hot = hot_keys(left, key, share)
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, how).unionByName(left.where(~is_hot).join(right.where(~is_hot), key, how))
