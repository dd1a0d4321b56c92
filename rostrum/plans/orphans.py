"""Problem 6: references to resolutions, speeches and documents that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.symbols import canonical_sql, canonical_symbol
from ..operators.orphans import Reference, Table, cascade
from ..tables import load
from . import Registry

query = Registry()


def graph(spark: SparkSession, sf: str) -> tuple[dict[str, Table], list[Reference]]:
    tables = {
        "documents": Table(load(spark, sf, "documents", "doc_id", "loaded_at"), key="doc_id"),
        "speeches": Table(load(spark, sf, "speeches", "id", "document_id", "loaded_at")),
        "resolutions": Table(load(spark, sf, "resolutions", "id", "draft_symbol", "adopted_symbol", "loaded_at", "deleted_at"), deleted="deleted_at", names=(canonical_symbol(F.col("draft_symbol")), canonical_symbol(F.col("adopted_symbol")))),
        "speech_resolution_mentions": Table(load(spark, sf, "speech_resolution_mentions", "id", "speech_id", "cited_symbol", "resolution_id", "loaded_at")),
        "resolution_citations": Table(load(spark, sf, "resolution_citations", "id", "citing_id", "cited_symbol", "cited_id", "loaded_at")),
    }
    references = [
        Reference("speech_resolution_mentions", "resolutions", F.col("resolution_id"), canonical_symbol(F.col("cited_symbol"))),
        Reference("resolution_citations", "resolutions", F.col("cited_id"), canonical_symbol(F.col("cited_symbol"))),
        Reference("resolution_citations", "resolutions", F.col("citing_id")),
        Reference("speech_resolution_mentions", "speeches", F.col("speech_id")),
        Reference("speeches", "documents", F.col("document_id")),
    ]
    return tables, references


_TARGETS = f"""targets as (
  select ref, bool_or(alive) as any_alive, min(case when alive then came end) as live_from from (
    select '#' || id as ref, loaded_at as came, deleted_at is null as alive from resolutions
    union all select {canonical_sql("draft_symbol")}, loaded_at, deleted_at is null from resolutions
    union all select {canonical_sql("adopted_symbol")}, loaded_at, deleted_at is null from resolutions) where ref is not null group by ref)"""

_REFS = f"""refs as (
  select 'speech_resolution_mentions' as ref_table, id as ref_id, loaded_at as came, coalesce('#' || resolution_id, {canonical_sql("cited_symbol")}) as ref from speech_resolution_mentions
  union all select 'resolution_citations', id, loaded_at, coalesce('#' || cited_id, {canonical_sql("cited_symbol")}) from resolution_citations)"""

_FOUND = """found as (
  select ref_table, ref_id, came, case when any_alive is null then 'missing' when not any_alive then 'deleted' when live_from > came then 'late' end as kind
  from refs left join targets using (ref) where ref is not null)"""


@query("p6_found", f"with {_TARGETS}, {_REFS}, {_FOUND} select ref_table, ref_id, kind from found where kind is not null")
def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """References to resolutions that are missing, deleted or late: ref_table, ref_id, kind."""
    tables, references = graph(spark, sf)
    found = cascade(tables, [r for r in references if r.or_name is not None])  # the part of the graph that is asked for
    return found.where(F.col("level") == 0).select("ref_table", "ref_id", "kind")


@query(
    "p6_report",
    f"""with {_TARGETS}, {_REFS}, {_FOUND},
lost_speeches as (select s.id, s.loaded_at as came, case when d.doc_id is null then 'missing' when d.loaded_at > s.loaded_at then 'late' end as kind from speeches s left join documents d on d.doc_id = s.document_id where s.document_id is not null),
direct as (
  select ref_table, ref_id, 'resolutions' as parent, came, kind from found where kind is not null
  union all select 'resolution_citations', c.id, 'resolutions', c.loaded_at, case when t.ref is null then 'missing' when not any_alive then 'deleted' when live_from > c.loaded_at then 'late' end
    from resolution_citations c left join targets t on t.ref = '#' || c.citing_id where c.citing_id is not null
  union all select 'speech_resolution_mentions', m.id, 'speeches', m.loaded_at, case when s.id is null then 'missing' when s.loaded_at > m.loaded_at then 'late' end
    from speech_resolution_mentions m left join speeches s on s.id = m.speech_id where m.speech_id is not null
  union all select 'speeches', id, 'documents', came, kind from lost_speeches),
inherited as (
  select 'speech_resolution_mentions' as ref_table, m.id as ref_id, 'speeches' as parent, m.loaded_at as came, 'inherited' as kind
  from speech_resolution_mentions m join lost_speeches s on s.id = m.speech_id and s.kind = 'missing'
  where m.id not in (select ref_id from direct where ref_table = 'speech_resolution_mentions' and kind is not null))
select ref_table, parent, strftime(came, '%Y-%m') as month, kind, count(*) as n
from (select * from direct where kind is not null union all select * from inherited) group by all""",
)
def p6_report(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans of the whole foreign-key graph, direct and inherited, per table, parent and month of loaded_at."""
    month = F.date_format("came", "yyyy-MM").alias("month")
    return cascade(*graph(spark, sf)).groupBy("ref_table", "parent", month, "kind").agg(F.count("*").alias("n"))
