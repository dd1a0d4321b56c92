"""Queries on functions that read set phrases: the phrases are written from the columns of whole tables, so that what must come out is known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.countries import canonical_countries
from ..tables import load
from . import Registry

query = Registry()


@query("vote_totals", "select o_orderkey, cast(o_orderkey % 190 as int) as yes, cast(o_orderkey % 17 as int) as no, cast(case when o_orderkey % 3 = 0 then 0 else o_orderkey % 31 end as int) as abstain from orders")
def vote_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Totals in all forms."""
    k = F.col("o_orderkey")
    none = k % 3 == 0
    said = (
        F.when(k % 4 == 0, F.concat(F.lit("It was adopted by "), k % 190, F.lit(" votes to "), k % 17, F.when(none, ".").otherwise(F.concat(F.lit(", with "), k % 31, F.lit(" abstentions.")))))
        .when(k % 4 == 1, F.concat(k % 190, F.lit(" in favour to "), k % 17, F.lit(" against"), F.when(none, ".").otherwise(F.concat(F.lit(", with "), k % 31, F.lit(" abstentions.")))))
        .when(k % 4 == 2, F.concat(F.lit("It received "), k % 190, F.lit(" votes in favour, "), k % 17, F.lit(" against"), F.when(none, ".").otherwise(F.concat(F.lit(" and "), k % 31, F.lit(" abstentions.")))))
        .otherwise(F.concat(F.lit("by "), k % 190, F.lit(" to "), k % 17, F.when(none, "").otherwise(F.concat(F.lit(" with "), k % 31, F.lit(" abstentions")))))
    )
    return load(spark, sf, "orders", "o_orderkey").select("o_orderkey", t.vote_totals(said).alias("v")).select("o_orderkey", "v.*")


@query("adoption_parse", "select o_orderkey, 'A/64/L.' || (o_orderkey % 90) as draft, case when o_orderkey % 2 = 0 then '64/' || (o_orderkey % 300) end as adopted from orders")
def adoption_parse(spark: SparkSession, sf: str) -> DataFrame:
    """T25."""
    k = F.col("o_orderkey")
    said = F.concat(F.lit("Draft resolution A/64/L."), k % 90, F.lit(" was adopted"), F.when(k % 2 == 0, F.concat(F.lit(" (resolution 64/"), k % 300, F.lit(")"))).otherwise(""), F.lit("."))
    return load(spark, sf, "orders", "o_orderkey").select("o_orderkey", t.adoption(said).alias("a")).select("o_orderkey", "a.*")


@query(
    "stage_directions",
    r"""select id, case when regexp_matches(x, '(?is)draft\s+(?:resolution|decision)\b.*was\s+adopted|the\s+amendment\s+\([^)]+\)\s+was\s+adopted') then 'adoption' when regexp_matches(x, 'It was so decided|(?i:the\s+decision\s+was\s+adopted)') then 'decision'
  when regexp_matches(x, '(?i)meeting\s+was\s+suspended') then 'suspension' when regexp_matches(x, '(?i)meeting\s+(?:was\s+)?resumed') then 'resumption' when regexp_matches(x, '(?i)meeting\s+rose') then 'adjournment' when regexp_matches(x, '(?i)minute\s+of\s+silence') then 'silence'
  when regexp_matches(x, '(?i)^\s*\(spoke\s+in\s+\w+\)\s*$') then 'language_note' else 'other' end as direction, count(*) as n from (select id, unnest(string_split_regex(text, '\n')) as x from speeches) group by all""",
)
def stage_directions(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of every speech by kind."""
    lines = load(spark, sf, "speeches", "id", "text").select("id", F.explode(F.split("text", "\n")).alias("x"))
    return lines.groupBy("id", t.stage_direction(F.col("x")).alias("direction")).agg(F.count("*").alias("n"))


@query("sponsorships", "select s_suppkey, case s_suppkey % 4 when 0 then 'list' when 1 then 'symbol' when 2 then 'parenthesis' else 'implicit' end as kind, case when s_suppkey % 4 < 3 then 'A/79/L.' || s_suppkey end as symbol, cast(case when s_suppkey % 4 = 0 then 2 else 0 end as int) as countries from supplier where s_suppkey % 7 > 0")
def sponsorships(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences on co-sponsors of all forms; every seventh sponsors no draft."""
    k = F.col("s_suppkey")
    said = (
        F.when(k % 7 == 0, F.lit("We were co-sponsor of the peace process."))
        .when(k % 4 == 0, F.concat(F.lit("The following countries are now co-sponsors of draft resolution A/79/L."), k, F.lit(": NATION_1 and NATION_2.")))
        .when(k % 4 == 1, F.concat(F.lit("We are glad to co-sponsor draft resolution A/79/L."), k, F.lit(".")))
        .when(k % 4 == 2, F.concat(F.lit("My country co-sponsored this text (A/79/L."), k, F.lit(").")))
        .otherwise("We cosponsor the text.")
    )
    found = load(spark, sf, "supplier", "s_suppkey").select("s_suppkey", t.sponsorship(said).alias("c")).where(F.col("c").isNotNull())
    return found.select("s_suppkey", "c.kind", "c.symbol", F.size("c.countries").alias("countries"))


@query("sponsor_lists", "select 'NATION_' || k as country, count(*) as n from (select unnest([s_suppkey % 25, 25 + s_suppkey % 7, 40 + s_suppkey % 3]) as k from supplier) group by 1")
def sponsor_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The names in sentences on co-sponsors."""
    k = F.col("s_suppkey")
    said = F.concat(F.lit("The co-sponsors are NATION_"), k % 25, F.lit(", NATION_"), 25 + k % 7, F.lit(" and NATION_"), 40 + k % 3, F.lit("."))
    return load(spark, sf, "supplier", "s_suppkey").select(F.explode(t.cosponsors(said)).alias("country")).groupBy("country").agg(F.count("*").alias("n"))


@query("speaker_labels", "select c_custkey, case when c_custkey % 5 = 0 then null else 'Mr.' end as title, case when c_custkey % 5 = 0 then null else 'NATION_' || c_nationkey end as country, c_mktsegment as language, case when c_custkey % 5 = 0 then 'President' end as role from customer")
def speaker_labels(spark: SparkSession, sf: str) -> DataFrame:
    """T16."""
    spoke = F.concat(F.lit(" (spoke in "), F.col("c_mktsegment"), F.lit("):"))
    label = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("The President"), spoke)).otherwise(F.concat(F.lit("Mr. Baro (NATION_"), F.col("c_nationkey"), F.lit(")"), spoke))
    c = load(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment").select("c_custkey", t.speaker_info(label).alias("s"))
    return c.select("c_custkey", "s.title", "s.country", "s.language", "s.role")


@query("agenda_headers", "select o_orderkey, cast(1 + o_orderkey % 150 as int) as agenda_number, case when o_orderkey % 2 = 0 then 'b' end as sub_item, o_orderkey % 3 = 0 as continued, 'Question of peace' as title from orders")
def agenda_headers(spark: SparkSession, sf: str) -> DataFrame:
    """T14."""
    k = F.col("o_orderkey")
    said = F.concat(F.lit("Agenda item "), 1 + k % 150, F.when(k % 2 == 0, " (b)").otherwise(""), F.when(k % 3 == 0, " (continued)").otherwise(""), F.lit(" Question of peace"))
    return load(spark, sf, "orders", "o_orderkey").select("o_orderkey", t.agenda_header(said).alias("a")).select("o_orderkey", "a.*")


@query(
    "draft_symbol_repair",
    "select id, regexp_replace(trim(draft_symbol, ' '), '[\\s.,;:)]+$', '') as repaired from resolutions where draft_symbol not like '%J%' and draft_symbol not like '%L,%' and draft_symbol not like '%C.I%'",
)
def draft_symbol_repair(spark: SparkSession, sf: str) -> DataFrame:
    """The symbols of all drafts as scans misread them, wherever the misreading applies."""
    r = load(spark, sf, "resolutions", "id", "draft_symbol").where(~F.col("draft_symbol").rlike(r"J|L,|C\.I"))
    misread = F.concat(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim("draft_symbol"), r"\bC\.1\b", "C.I"), r"\bL\.", "L,"), r"(?<=[02-9])1(?=[02-9]|$)", "J"), F.lit(" ;"))
    return r.select("id", t.repair_draft_symbol(misread).alias("repaired"))


@query("title_case", "select category_id, array_to_string(list_transform(string_split(category, ' '), lambda w, i: case when i > 1 and w in ('of', 'and', 'the', 'for', 'in', 'on') then w else upper(w[1]) || lower(w[2:]) end), ' ') as title from category_list")
def title_case(spark: SparkSession, sf: str) -> DataFrame:
    """T1."""
    return load(spark, sf, "category_list", "category_id", "category").select("category_id", t.normalize_allcaps(F.upper("category")).alias("title"))


@query("sentence_counts", r"select id, len(regexp_extract_all(text, '[.!?]+[ \t\n\r\f\v]+')) + 1 as sentences from speeches")
def sentence_counts(spark: SparkSession, sf: str) -> DataFrame:
    """T30."""
    return load(spark, sf, "speeches", "id", "text").select("id", F.size(t.sentences(F.col("text"))).cast("long").alias("sentences"))


@query("veto_symbols", r"select dppa_id, case when regexp_full_match(meeting_symbol, '\d+') then 'S/PV.' || meeting_symbol else meeting_symbol end as symbol, try_cast(nullif(regexp_extract(upper(meeting_symbol), 'PV\.? ?(\d+)', 1), '') as int) as number from vetoes")
def veto_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """T34 T36."""
    m = F.col("meeting_symbol")
    return load(spark, sf, "vetoes", "dppa_id", "meeting_symbol").select("dppa_id", F.when(m.rlike(r"^\d+$"), F.concat(F.lit("S/PV."), m)).otherwise(m).alias("symbol"), t.extracted(F.upper(m), r"PV\.? ?(\d+)").cast("int").alias("number"))


@query("vote_codes", "select event_id, case event_type when 'click' then 'yes' when 'view' then 'no' when 'error' then 'abstain' when 'signup' then 'non_voting' end as position from events where event_type <> 'purchase'")
def vote_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Codes by a map; unknown ones are left out."""
    codes = F.create_map(*(F.lit(x) for kv in {"click": "yes", "view": "no", "error": "abstain", "signup": "non_voting"}.items() for x in kv))
    e = load(spark, sf, "events", "event_id", "event_type").withColumn("position", F.try_element_at(codes, F.col("event_type")))
    return e.where(F.col("position").isNotNull()).select("event_id", "position")


@query("typed_dates", "select doc_id, cast(date as varchar) as date from documents")
def typed_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates in several formats."""
    k = F.col("doc_id") % 2
    typed = F.when(k == 0, F.date_format("date", "yyyy-MM-dd")).otherwise(F.date_format("date", "dd/MM/yyyy"))
    return load(spark, sf, "documents", "doc_id", "date").select("doc_id", t.any_date(typed).cast("string").alias("date"))


@query(
    "representative_speakers",
    r"""with r as (select id, case when contains(name, ',') then trim(concat_ws(' ', trim(regexp_extract(name, ',\s*(.*)$', 1)), trim(regexp_extract(name, '^([^,]*)', 1)))) else trim(name) end as n from sc_representatives),
  s as (select distinct speaker.name as speaker from speeches where not lower(speaker.name) like 'the %'), k as (select id, n, upper(regexp_extract(n, '(\S+)$', 1)) as w from r), l as (select speaker, upper(regexp_extract(trim(speaker), '(\S+)$', 1)) as w from s)
  select id, speaker, cast(tier as int) as tier from (select id, speaker, case when n = speaker then 0 else 1 end as tier, row_number() over (partition by id order by case when n = speaker then 0 else 1 end, speaker) as rank from k join l using (w)) where rank = 1""",
)
def representative_speakers(spark: SparkSession, sf: str) -> DataFrame:
    """A representative's speaker: the same name, else one with the same last word; the first in order."""
    last = lambda c: F.upper(F.regexp_extract(F.trim(c), r"(\S+)$", 1))
    r = load(spark, sf, "sc_representatives", "id", "name").withColumn("n", t.normalise_name(F.col("name"))).withColumn("w", last(F.col("n")))
    s = load(spark, sf, "speeches").select(F.col("speaker.name").alias("speaker")).distinct().where(~F.lower("speaker").like("the %")).withColumn("w", last(F.col("speaker")))
    best = r.join(s, "w").groupBy("id").agg(F.min(F.struct(F.when(F.col("n") == F.col("speaker"), 0).otherwise(1).alias("tier"), "speaker")).alias("b"))
    return best.select("id", "b.speaker", "b.tier")


@query(
    "canonical_country",
    """with a as (select lower(alias) as k, min(member_state) as c from (select member_state as alias, member_state from member_states union all select unnest(string_split(other_names, '|')), member_state from member_states where other_names is not null union all select earlier_name, member_state from member_states where earlier_name is not null) group by 1)
  select state_id, c as canonical from member_states join a on lower(member_state) = k""",
)
def canonical_country(spark: SparkSession, sf: str) -> DataFrame:
    """Names in capitals, with notes and torn words, find their entry."""
    m = load(spark, sf, "member_states", "state_id", "member_state", "other_names", "earlier_name")
    alias = m.select(F.explode(F.array_compact(F.concat(F.array("member_state", "earlier_name"), F.coalesce(F.split("other_names", r"\|"), F.array().cast("array<string>"))))).alias("alias"), F.col("member_state").alias("canonical"))
    k = F.col("state_id") % 4
    typed = F.when(k == 0, F.upper("member_state")).when(k == 1, F.concat(F.lit(" '"), F.col("member_state"), F.lit(". (spoke in French)"))).when(k == 2, F.regexp_replace("member_state", "([a-z])([a-z]{2})$", "$1- $2")).otherwise(F.col("member_state"))
    return canonical_countries(m.select("state_id", typed.alias("value")), alias).select("state_id", "canonical")
