"""Queries on write semantics: the state after a batch, with the events table split by time into old rows and new ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import upsert
from ..operators.merge import master_merge, quarantine, repoint, repoint_pairs
from ..operators.pairs import pairs_in_group
from ..runtime import join_hot
from ..tables import load
from . import Registry

query = Registry()

SPLIT = "timestamp '2024-01-15 00:00:00'"
_OLD = f"old as (select user_id, event_type, value from (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as r from events where ts < {SPLIT}) where r = 1)"
_NEW = f"incoming as (select *, nullif(value, floor(value)) as v from events where ts >= {SPLIT}), latest as (select user_id, event_type, v as value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as r from incoming) where r = 1)"


def batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """State before: the first event of each user and type. Incoming: later events; whole values count as missing."""
    e = load(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value")
    split = F.expr(SPLIT)
    old = upsert.first_of(e.where(F.col("ts") < split), ["user_id", "event_type"], F.col("ts"), F.col("event_id")).select("user_id", "event_type", "value")
    new = e.where(F.col("ts") >= split).withColumn("value", F.nullif("value", F.floor("value").cast("double")))
    return old, upsert.first_of(new, ["user_id", "event_type"], F.col("ts").desc(), F.col("event_id").desc()).select("user_id", "event_type", "value")


KEY = ["user_id", "event_type"]


@query("dedup_first", "select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as r from events) where r = 1")
def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    """The first row of each key."""
    e = load(spark, sf, "events", "event_id", "ts", "user_id", "event_type")
    return upsert.first_of(e, KEY, F.col("ts"), F.col("event_id")).select("user_id", "event_type", "event_id")


@query("insert_if_absent", f"with {_OLD}, {_NEW} select * from old union all select * from latest l where not exists (select 1 from old o where o.user_id = l.user_id and o.event_type = l.event_type)")
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """K4."""
    return upsert.insert_if_absent(*batches(spark, sf), KEY)


@query("upsert_overwrite", f"with {_OLD}, {_NEW} select * from latest union all select * from old o where not exists (select 1 from latest l where o.user_id = l.user_id and o.event_type = l.event_type)")
def upsert_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """K5."""
    return upsert.overwrite(*batches(spark, sf), KEY)


@query("upsert_keep", f"with {_OLD}, {_NEW} select * from old union all select * from latest l where not exists (select 1 from old o where o.user_id = l.user_id and o.event_type = l.event_type)")
def upsert_keep(spark: SparkSession, sf: str) -> DataFrame:
    """K6."""
    return upsert.keep_first(*batches(spark, sf), KEY)


@query("upsert_coalesce", f"with {_OLD}, {_NEW} select user_id, event_type, coalesce(l.value, o.value) as value from old o full join latest l using (user_id, event_type)")
def upsert_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    """Incoming values that aren't null win."""
    return upsert.merged(*batches(spark, sf), KEY, {"value": "new"})


@query("upsert_keep_filled", f"with {_OLD}, {_NEW} select user_id, event_type, coalesce(o.value, l.value) as value from old o full join latest l using (user_id, event_type)")
def upsert_keep_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Old values that aren't null stay."""
    return upsert.merged(*batches(spark, sf), KEY, {"value": "old"})


@query("partition_replace", f"with {_OLD}, {_NEW} select * from latest where event_type in ('click', 'view') union all select * from old where event_type not in (select distinct event_type from latest where event_type in ('click', 'view'))")
def partition_replace(spark: SparkSession, sf: str) -> DataFrame:
    """K8 K9: the partitions that come in replace the old ones."""
    old, new = batches(spark, sf)
    return upsert.replace_partitions(old, new.where(F.col("event_type").isin("click", "view")), ["event_type"])


@query("delete_cascade", "select l_orderkey, l_linenumber from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'P')")
def delete_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Children of deleted parents go too."""
    o, l = load(spark, sf, "orders", "o_orderkey", "o_orderstatus"), load(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    return upsert.delete_cascade(o, {"lineitem": (l, "l_orderkey")}, o.where(F.col("o_orderstatus") == "P"), "o_orderkey")["lineitem"]


@query("back_fill_keys", "select m.id, coalesce(m.resolution_id, r.id) as resolution_id from speech_resolution_mentions m left join (select adopted_symbol, min(id) as id from resolutions where adopted_symbol is not null group by 1) r on r.adopted_symbol = m.cited_symbol")
def back_fill_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Missing foreign keys from a lookup."""
    m = load(spark, sf, "speech_resolution_mentions", "id", "cited_symbol", "resolution_id")
    r = load(spark, sf, "resolutions", "id", "adopted_symbol").where(F.col("adopted_symbol").isNotNull()).groupBy(F.col("adopted_symbol").alias("cited_symbol")).agg(F.min("id").alias("resolution_id"))
    found = join_hot(m, r.withColumnRenamed("resolution_id", "_fill"), "cited_symbol")  # one symbol may hold a third of the rows
    return found.select("id", F.coalesce("resolution_id", "_fill").alias("resolution_id"))


@query("flag_debates", "select doc_id, case when exists (select 1 from speeches s where s.document_id = doc_id and s.speech_type = 'explanation_of_vote') then true else coalesce(ods_used, false) end as flag from documents")
def flag_debates(spark: SparkSession, sf: str) -> DataFrame:
    """A flag set where a condition on another table holds."""
    d = load(spark, sf, "documents", "doc_id", "ods_used").select("doc_id", F.coalesce("ods_used", F.lit(False)).alias("flag"))
    s = load(spark, sf, "speeches", "document_id", "speech_type").where(F.col("speech_type") == "explanation_of_vote").select(F.col("document_id").alias("doc_id"))
    return upsert.flag_where(d, s, ["doc_id"], "flag")


_XREF = "xref as (select n_nationkey as old_id, n_nationkey % 20 as new_id from nation where n_nationkey >= 20)"


def nation_xref(spark: SparkSession, sf: str) -> DataFrame:
    n = load(spark, sf, "nation", "n_nationkey").where("n_nationkey >= 20")
    return n.select(F.col("n_nationkey").alias("old_id"), (F.col("n_nationkey") % 20).alias("new_id"))


@query("country_merge", f"with {_XREF} select coalesce(new_id, c_nationkey) as c_nationkey, count(*) as customers from customer left join xref on old_id = c_nationkey group by 1")
def country_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A referring table after a merge."""
    return repoint(load(spark, sf, "customer", "c_custkey", "c_nationkey"), nation_xref(spark, sf), ["c_nationkey"]).groupBy("c_nationkey").agg(F.count("*").alias("customers"))


@query(
    "country_merge_pairs",
    f"""with {_XREF}, s as (select distinct l_orderkey, s_nationkey from lineitem join supplier on l_suppkey = s_suppkey), p as (select a.s_nationkey as a, b.s_nationkey as b, count(*) as n from s a join s b on a.l_orderkey = b.l_orderkey and a.s_nationkey < b.s_nationkey group by all),
  m as (select coalesce(x.new_id, a) as u, coalesce(y.new_id, b) as v, n from p left join xref x on x.old_id = a left join xref y on y.old_id = b)
  select least(u, v) as a, greatest(u, v) as b, max(n) as n from m where u != v group by all""",
)
def country_merge_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs are turned and those that fall together become one."""
    l, s = load(spark, sf, "lineitem", "l_orderkey", "l_suppkey"), load(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    rows = l.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "s_nationkey").distinct()
    p = pairs_in_group(rows, ["l_orderkey"], "s_nationkey").groupBy("a", "b").agg(F.count("*").alias("n"))
    return repoint_pairs(p, nation_xref(spark, sf), "a", "b", [], F.col("n").desc())


@query("quarantine_countries", "select id, coalesce(regexp_full_match(iso3, '[A-Z]{3}'), false) as usable from countries")
def quarantine_countries(spark: SparkSession, sf: str) -> DataFrame:
    """Records without a code are set apart, not deleted."""
    good, bad = quarantine(load(spark, sf, "countries", "id", "iso3"), F.col("iso3").rlike("^[A-Z]{3}$"))
    return good.select("id", F.lit(True).alias("usable")).unionByName(bad.select("id", F.lit(False).alias("usable")))


@query("country_passes")
def country_passes(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of each country: kept, renamed, merged or deleted, by its name in the list of states or the most similar one."""
    m = load(spark, sf, "member_states", "member_state", "iso_code", "other_names", "earlier_name")
    names = F.array_compact(F.concat(F.array("member_state", "earlier_name"), F.coalesce(F.split("other_names", r"\|"), F.array().cast("array<string>"))))
    listed = m.select(F.explode(names).alias("alias"), F.col("iso_code").alias("code"), F.col("member_state").alias("canonical"))
    return master_merge(load(spark, sf, "countries", "id", "name", "iso3").withColumnRenamed("iso3", "code"), listed)
