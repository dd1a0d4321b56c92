"""Reading of the input tables, and the explicit schemas of the record formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The parquet table `name` of `folder`; with `columns`, only those are read."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
