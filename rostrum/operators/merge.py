"""Merging of duplicate master records: every table that refers to them is re-pointed."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.countries import canonical_countries
from .upsert import first_of

#: Least similarity of a fuzzy match, and least letters of a name that is matched so.
CUTOFF, LETTERS = 0.82, 4
#: A list that every task holds must stay under this.
MOST_NAMES = 100_000


def repoint(rows: DataFrame, xref: DataFrame, columns: list[str]) -> DataFrame:
    """rows with each column mapped by xref(old_id, new_id); ids that xref doesn't hold stay."""
    for c in columns:
        rows = rows.join(xref.select(F.col("old_id").alias(c), F.col("new_id").alias("_new")), c, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    return rows


def repoint_pairs(pairs: DataFrame, xref: DataFrame, a: str, b: str, key: list[str], *order) -> DataFrame:
    """Unordered pairs after a merge: re-pointed, turned so that a < b, pairs of one record dropped, and of those that fall together the first by `order`."""
    moved = repoint(pairs, xref, [a, b])
    turned = moved.withColumn("_l", F.least(a, b)).withColumn("_g", F.greatest(a, b)).drop(a, b).withColumnsRenamed({"_l": a, "_g": b}).where(F.col(a) != F.col(b))
    return first_of(turned.select(*pairs.columns), [a, b, *key], *order)


def quarantine(rows: DataFrame, usable) -> tuple[DataFrame, DataFrame]:
    """Rows that fulfil the condition, and the rest, which is set apart instead of being deleted."""
    ok = F.coalesce(usable, F.lit(False))
    return rows.where(ok), rows.where(~ok)


def fuzzy_best(values: DataFrame, listed: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Value, alias for each distinct value of values(value): the one of listed(alias) that is most like it, in lower case, by matching blocks (twice the matching letters over all letters), if by `cutoff` or more; of equals the last in order. Values under LETTERS letters have none. The size of the list is checked."""
    rows = listed.select(F.lower("alias").alias("k"), "alias").where(F.col("k").isNotNull()).groupBy("k").agg(F.min("alias").alias("alias")).orderBy("k").limit(MOST_NAMES + 1).collect()
    if len(rows) > MOST_NAMES:
        raise ValueError(f"the list has more than {MOST_NAMES} names")
    alias_of = {r["k"]: r["alias"] for r in rows}
    keys = list(alias_of)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            best = [(v, m[0]) for v in b["value"] if len(v.strip()) >= LETTERS and (m := difflib.get_close_matches(v.lower(), keys, n=1, cutoff=cutoff))]
            yield pd.DataFrame([(v, alias_of[k]) for v, k in best], columns=["value", "alias"])

    return values.select("value").where(F.col("value").isNotNull()).distinct().mapInPandas(run, "value string, alias string")


def master_merge(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """Id, action, new_id, name, code for each of rows(id, name, code), against listed(alias, code, canonical).

    Names become canonical first: a row whose name changes merges into the row that has that name already, or else the first such row is renamed and the others merge into it. Of the rest, rows without code are matched with the list by likeness: they merge into the first row of that code, or the first of them is renamed and gets it. What is left without a code is no state and is deleted (new_id null); all others are kept. Use the result as xref for `repoint`.
    """
    named = canonical_countries(rows.select("id", "code", F.col("name").alias("value")), listed.select("alias", "canonical"))
    # a name that is no alias stays as it is written
    known = listed.select(F.lower("canonical").alias("k")).distinct()
    named = named.withColumn("k", F.lower("canonical")).join(known.withColumn("listed", F.lit(True)), "k", "left").withColumn("name", F.when(F.col("listed"), F.col("canonical")).otherwise(F.col("value"))).select("id", "code", "value", "name")
    changed = ~F.col("name").eqNullSafe(F.col("value"))
    w = Window.partitionBy("name")
    target = F.min(F.struct(changed.cast("int").alias("c"), "id")).over(w)["id"]
    one = named.withColumn("target", F.when(changed, target).otherwise(F.col("id"))).withColumn("action", F.when(~changed, "keep").when(F.col("target") == F.col("id"), "rename").otherwise("merge"))
    left = one.where("action <> 'merge' and code is null")
    codes = listed.groupBy("alias").agg(F.min(F.struct("code", "canonical")).alias("x")).select("alias", F.col("x.code").alias("like"), F.col("x.canonical").alias("as"))
    like = left.join(fuzzy_best(left.select(F.col("name").alias("value")), listed).join(codes, "alias").withColumnRenamed("value", "name"), "name").select("id", "like", "as")
    bears = one.where("action <> 'merge' and code is not null").groupBy(F.col("code").alias("like")).agg(F.min("id").alias("bearer"))
    fuzzy = like.join(bears, "like", "left").withColumn("first", F.min("id").over(Window.partitionBy("like")))
    fuzzy = fuzzy.select("id", "like", "as", F.coalesce("bearer", "first").alias("to"), F.when(F.coalesce("bearer", "first") == F.col("id"), "fuzzy_rename").otherwise("fuzzy_merge").alias("by"))
    both = one.join(fuzzy, "id", "left")
    gone = (F.col("action") != "merge") & F.col("code").isNull() & F.col("by").isNull()
    two = both.select("id", F.when(gone, "delete").otherwise(F.coalesce("by", "action")).alias("action"), F.when(~gone, F.coalesce("to", "target")).alias("new_id"), F.when(~gone, F.coalesce("as", "name")).alias("own"), F.when(~gone, F.coalesce("like", "code")).alias("own_code"))
    # what merges takes name and code, and the fate, of the row that it merges into
    into = two.select(F.col("id").alias("new_id"), F.col("action").alias("a"), F.col("new_id").alias("n"), F.col("own").alias("name"), F.col("own_code").alias("code"))
    out = two.join(into, "new_id", "left")
    return out.select("id", F.when(F.col("a") == "delete", "delete").otherwise(F.col("action")).alias("action"), F.col("n").alias("new_id"), "name", "code")
