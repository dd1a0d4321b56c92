"""The best representative of each group of duplicate records, field by field."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans import Registry
from ..tables import load

query = Registry()

# What people write where they know no name or code.
NO_VALUE = ("", "-", "--", "---", "—", "?", "??", "???", "0", "n/a", "na", "none", "null", "nil", "x", "xx", "xxx", "zzz", "tbd", "tba", "unknown", "not stated", "unnamed", "name to be confirmed", "to be confirmed", "illegible", "blank")
#: No state acceded before the founding day.
FIRST_ACCESSION = "1945-10-24"


@dataclass(frozen=True)
class Field:
    """A field of the survivor; `usable` is an SQL condition on whether a row's value may supply it."""

    name: str
    usable: str


def filled(c: str) -> str:
    """Filled, and in lower case, without brackets and spaces at the ends, none of NO_VALUE."""
    known = ", ".join(f"'{x}'" for x in NO_VALUE)
    return rf"({c} is not null and regexp_replace(lower({c}), r'^[\s(\[{{]+|[\s)\]}}]+$', '') not in ({known}))"


COUNTRY_FIELDS = (
    Field("name", rf"{filled('name')} and name rlike r'\p{{L}}{{2}}'"),
    Field("iso3", f"{filled('iso3')} and trim(iso3) rlike '^[A-Za-z]{{3}}$'"),
    Field("un_member_since", f"un_member_since between date '{FIRST_ACCESSION}' and coalesce(to_date(updated_at), current_date())"),
)


def suppliers(rows: DataFrame, sources: DataFrame, group: str, key: str, fields: tuple[Field, ...], source: str = "source", trust: str = "trust", updated: str = "updated_at", least: int = 2) -> DataFrame:
    """For each group of `least` rows or more and each field: which row supplies the surviving value. Columns: group, field, key.

    Rows with a usable value are ranked by the trust of their source, then by recency, then by how many of the fields they fill, then by the lowest key; the first supplies the value. An unknown or null source has the lowest trust, a null time is the oldest. Rows with a null group belong to none. Groups where no row has a usable value for a field give no row for it. Repeated rows are ranked like others. An empty table gives an empty result.

    The filter row_number = 1 lets Spark keep one row for each group and field in each map task before the shuffle (WindowGroupLimit), so that a group with a third of all rows costs no more than others.
    """
    known = sources.select(F.col(source).alias("_source"), F.col(trust).alias("_trust")).groupBy("_source").agg(F.max("_trust").alias("_trust"))
    full = sum((F.coalesce(F.expr(f.usable), F.lit(False)).cast("int") for f in fields), F.lit(0))
    which = F.array_compact(F.array(*(F.when(F.expr(f.usable), F.lit(f.name)) for f in fields)))
    each = rows.where(F.col(group).isNotNull()).select(F.col(group).alias("_group"), F.col(key).alias("_key"), F.col(source).alias("_source"), F.col(updated).alias("_updated"), full.alias("_full"), which.alias("_fields"))
    several = each.groupBy("_group").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("_group")
    ranked = each.join(known, "_source", "left").select("_group", "_key", "_trust", "_updated", "_full", F.explode("_fields").alias("field"))
    order = W.partitionBy("_group", "field").orderBy(F.col("_trust").desc_nulls_last(), F.col("_updated").desc_nulls_last(), F.col("_full").desc(), F.col("_key"))
    first = ranked.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1)
    return first.join(several, "_group", "left_semi").select(F.col("_group").alias(group), "field", F.col("_key").alias(key))


def survivors(rows: DataFrame, supplied: DataFrame, group: str, key: str, fields: tuple[Field, ...]) -> DataFrame:
    """The surviving record of each group, built from the rows that `suppliers` names: group, and each field (null where no row has a usable value)."""
    values = rows.select(F.col(key).alias("_key"), *(F.col(f.name).alias(f"_{f.name}") for f in fields))
    joined = supplied.select(F.col(group).alias("_group"), "field", F.col(key).alias("_key")).join(values, "_key")
    return joined.groupBy(F.col("_group").alias(group)).agg(*(F.max(F.when(F.col("field") == f.name, F.col(f"_{f.name}"))).alias(f.name) for f in fields))


_PLACEHOLDERS = ", ".join("'" + x + "'" for x in NO_VALUE)
_BARE = r"regexp_replace(lower({c}), '^[\s(\[{{]+|[\s)\]}}]+$', '', 'g')"
_SQL = rf"""with usable as (
  select c.merge_group, c.id, c.updated_at, coalesce(s.trust, -1) as trust,
    coalesce(name is not null and {_BARE.format(c="name")} not in ({_PLACEHOLDERS}) and regexp_matches(name, '\pL{{2}}'), false) as ok_name,
    coalesce(iso3 is not null and {_BARE.format(c="iso3")} not in ({_PLACEHOLDERS}) and regexp_full_match(trim(iso3), '[A-Za-z]{{3}}'), false) as ok_iso3,
    coalesce(un_member_since between date '{FIRST_ACCESSION}' and coalesce(updated_at::date, current_date), false) as ok_since
  from countries c left join data_sources s using (source)
  where merge_group in (select merge_group from countries group by 1 having count(*) >= 2)),
each as (
  select *, 'name' as field from usable where ok_name union all select *, 'iso3' from usable where ok_iso3 union all select *, 'un_member_since' from usable where ok_since),
firsts as (
  select merge_group, field, id from each
  qualify row_number() over (partition by merge_group, field order by trust desc, updated_at desc nulls last, ok_name::int + ok_iso3::int + ok_since::int desc, id) = 1)
"""


def _suppliers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = load(spark, sf, "countries", "id", "name", "iso3", "un_member_since", "source", "updated_at", "merge_group")
    return rows, suppliers(rows, load(spark, sf, "data_sources", "source", "trust"), "merge_group", "id", COUNTRY_FIELDS)


@query("p3_found", _SQL + "select merge_group, field, id as country_id from firsts")
def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """For each merge_group and field the countries.id that supplies the surviving value."""
    return _suppliers(spark, sf)[1].withColumnRenamed("id", "country_id")


@query("p3_records", _SQL + "select f.merge_group, max(case when field = 'name' then name end) as name, max(case when field = 'iso3' then iso3 end) as iso3, max(case when field = 'un_member_since' then un_member_since::varchar end) as un_member_since from firsts f join countries c on c.id = f.id group by 1")
def p3_records(spark: SparkSession, sf: str) -> DataFrame:
    """The surviving record of each merge_group."""
    rows, supplied = _suppliers(spark, sf)
    return survivors(rows, supplied, "merge_group", "id", COUNTRY_FIELDS).withColumn("un_member_since", F.col("un_member_since").cast("string"))
