"""Write semantics on immutable tables: each rule gives the new full state as a plan.

All of them take the state before (`old`) and what comes in (`new`), keyed by `key`. Of several incoming rows of one key the last by `order` counts (the first for keep_first), ties broken by the whole row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_of(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """One row for each key, the first by `order`; the filter is applied before the shuffle too (WindowGroupLimit)."""
    ties = [F.col(c) for c, t in df.dtypes if c not in key and not t.startswith("map")]
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*key).orderBy(*order, *ties))).where("_r = 1").drop("_r")


def insert_if_absent(old: DataFrame, new: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """K4: incoming rows of keys that aren't there yet, in addition to the old rows."""
    return old.unionByName(first_of(new, key, *order).join(old.select(*key), key, "left_anti"))


def keep_first(old: DataFrame, new: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """K6: on conflict nothing happens."""
    return insert_if_absent(old, new, key, *order)


def overwrite(old: DataFrame, new: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """K5: on conflict the incoming row replaces all columns."""
    last = first_of(new, key, *order)
    return old.join(last.select(*key), key, "left_anti").unionByName(last)


def merged(old: DataFrame, new: DataFrame, key: list[str], rules: dict[str, str], *order: Column) -> DataFrame:
    """Column by column: `new` takes the incoming value where it isn't null, `old` keeps the old one where that isn't null, `replace` takes the incoming value even if null."""
    last = first_of(new, key, *order)
    o, n = old.select(*key, *(F.col(c).alias(f"_o_{c}") for c in rules), F.lit(True).alias("_o")), last.select(*key, *(F.col(c).alias(f"_n_{c}") for c in rules), F.lit(True).alias("_n"))
    both = o.join(n, key, "full")

    def value(c: str, rule: str) -> Column:
        a, b = F.col(f"_o_{c}"), F.col(f"_n_{c}")
        return {"new": F.coalesce(b, a), "old": F.coalesce(a, b), "replace": F.when(F.col("_n").isNotNull(), b).otherwise(a)}[rule].alias(c)

    return both.select(*key, *(value(c, r) for c, r in rules.items()))


def replace_partitions(old: DataFrame, new: DataFrame, partition: list[str]) -> DataFrame:
    """K8 K9: all rows of the partitions that come in are replaced."""
    return old.join(new.select(*partition).distinct(), partition, "left_anti").unionByName(new)


def write_partitions(df: DataFrame, path: str, partition: list[str]) -> None:
    """K8 on disk: only the partitions that df holds are replaced; repeating it changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def delete_where(old: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Without the rows whose key is in keys."""
    return old.join(keys.select(*on).distinct(), on, "left_anti")


def delete_cascade(parent: DataFrame, children: dict[str, tuple[DataFrame, str]], gone: DataFrame, key: str) -> dict[str, DataFrame]:
    """The parent without the keys in `gone`, and each child (rows, its reference) without rows that refer to them."""
    out = {"": parent.join(gone.select(key), key, "left_anti")}
    for name, (rows, by) in children.items():
        out[name] = rows.join(gone.select(F.col(key).alias(by)), by, "left_anti")
    return out


def back_fill(rows: DataFrame, lookup: DataFrame, on: list[str], column: str) -> DataFrame:
    """Null values of a column from a lookup(on..., column) with one row for each key."""
    return rows.join(lookup.select(*on, F.col(column).alias("_fill")), on, "left").withColumn(column, F.coalesce(column, "_fill")).drop("_fill")


def flag_where(rows: DataFrame, keys: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Sets a flag on the rows whose key is in keys."""
    return rows.join(keys.select(*on).distinct().withColumn("_hit", F.lit(True)), on, "left").withColumn(flag, F.coalesce("_hit", flag)).drop("_hit")
