"""References to records that do not exist: a fixpoint cascade of semi-joins down the foreign-key graph."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, join_hot


@dataclass(frozen=True)
class Table:
    """A table of the graph: its rows, its key, when a row came, and (optional) when it was deleted. `names` are further keys by which a row may be meant."""

    df: DataFrame
    key: str = "id"
    came: str | None = "loaded_at"
    deleted: str | None = None
    names: tuple[Column, ...] = ()


@dataclass(frozen=True)
class Reference:
    """`child` refers to `parent` by the key column `by`, or, where that is null, by the name `or_name`."""

    child: str
    parent: str
    by: Column
    or_name: Column | None = None


def targets(table: Table) -> DataFrame:
    """One row for each key or name of the table: ref, live_from (when its first row that isn't deleted came; null: all are deleted)."""
    alive = F.col(table.deleted).isNull() if table.deleted else F.lit(True)
    came = F.col(table.came) if table.came else F.lit(None).cast("timestamp_ntz")
    refs = [F.concat(F.lit("#"), F.col(table.key).cast("string")), *table.names]
    each = table.df.select(F.explode(F.array_compact(F.array_distinct(F.array(*refs)))).alias("ref"), came.alias("came"), alive.alias("alive"))
    return each.groupBy("ref").agg(F.min(F.when(F.col("alive"), F.col("came"))).alias("live_from"), F.bool_or("alive").alias("any_alive"))


def direct_orphans(tables: dict[str, Table], reference: Reference) -> DataFrame:
    """The rows of reference.child whose reference doesn't hold: ref_id, came, kind.

    kind is `missing` (no such parent), `deleted` (all such parents are deleted), else `late` (the first that isn't deleted came after the reference). A row where both the key and the name are null refers to nothing and is no orphan. Where several parents bear one name, the reference holds if any of them fulfils it. Times that are null are never late.
    """
    child, parent = tables[reference.child], tables[reference.parent]
    ref = F.concat(F.lit("#"), reference.by.cast("string"))
    if reference.or_name is not None:
        ref = F.coalesce(ref, reference.or_name)
    came = F.col(child.came) if child.came else F.lit(None).cast("timestamp_ntz")
    refs = cut(child.df.select(F.col(child.key).alias("ref_id"), came.alias("came"), ref.alias("ref")).where(F.col("ref").isNotNull()))  # read three times
    found = join_hot(refs, targets(parent), "ref")
    kind = F.when(F.col("any_alive").isNull(), "missing").when(~F.col("any_alive"), "deleted").when(F.col("live_from") > F.col("came"), "late")
    return found.select("ref_id", "came", kind.alias("kind")).where(F.col("kind").isNotNull())


def cascade(tables: dict[str, Table], references: list[Reference]) -> DataFrame:
    """Orphans of the whole graph: ref_table, ref_id, parent, came, kind, level.

    Level 0 are direct orphans (kinds of direct_orphans). A row that refers to an orphan whose parent is missing or deleted is an orphan of the next level, of kind `inherited`, unless it is one already; a `late` parent has arrived and passes nothing on. Each round is one semi-join for each reference, from the last round's new orphans only, until a round finds none; the frontier is written to the shared folder.
    """
    cols = ("ref_table", "ref_id", "parent", "came", "kind", "level")
    direct = [direct_orphans(tables, r).select(F.lit(r.child).alias("ref_table"), "ref_id", F.lit(r.parent).alias("parent"), "came", "kind", F.lit(0).alias("level")) for r in references]
    found = cut(reduce(DataFrame.unionByName, direct))
    fresh, level = found.where(F.col("kind") != "late").select("ref_table", "ref_id").distinct(), 0
    while not fresh.isEmpty():
        level += 1
        below = []
        for r in references:
            child = tables[r.child]
            if r.parent not in {x.child for x in references}:
                continue  # rows of this parent refer to nothing, so none of them is an orphan
            frontier = fresh.where(F.col("ref_table") == r.parent).select(F.col("ref_id").alias("parent_id"))
            came = F.col(child.came) if child.came else F.lit(None).cast("timestamp_ntz")
            rows = child.df.select(F.lit(r.child).alias("ref_table"), F.col(child.key).alias("ref_id"), F.lit(r.parent).alias("parent"), came.alias("came"), r.by.alias("parent_id"))
            below.append(rows.join(frontier, "parent_id", "left_semi").drop("parent_id"))
        if not below:
            break
        new = reduce(DataFrame.unionByName, below).join(found.select("ref_table", "ref_id"), ["ref_table", "ref_id"], "left_anti").dropDuplicates(["ref_table", "ref_id", "parent"])
        new = cut(new.withColumn("kind", F.lit("inherited")).withColumn("level", F.lit(level)).select(*cols))
        fresh = new.select("ref_table", "ref_id").distinct()
        found = found.unionByName(new)
    return found
