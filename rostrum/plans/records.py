"""Queries on segmentation: speeches and documents of the tables as pages of blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import sections as s
from ..sources.html import html_blocks
from ..tables import load
from . import Registry

query = Registry()


def blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The paragraphs of all documents as blocks; the first is a heading, those of an office bold."""
    d = load(spark, sf, "documents", "doc_id", "title", "text").where(F.col("text").isNotNull())
    b = d.select(F.col("doc_id").alias("doc"), F.posexplode(F.concat(F.array(F.concat(F.lit("Agenda item 1 "), F.coalesce("title", F.lit("")))), F.split("text", r"\n+"))).alias("seq", "text"))
    return b.select("doc", "seq", "text", F.col("text").rlike("^(?:The|Mr|Ms) ").alias("bold_start"), F.col("text").rlike("^(?:The meeting rose|There being)").alias("all_italic"))


_KIND = r"""case when regexp_matches(text, '^(?:The meeting rose|There being)') or (regexp_matches(text, '(?i)\bwas adopted\b') and length(text) < 200) then 'stage' when regexp_matches(text, '(?i)^\s*agenda items?\s+\d+') then 'agenda' when regexp_matches(text, '(?i)^\s*draft (?:resolution|decision)\s*\(?[as]?/?') then 'draft'
  when regexp_matches(text, '^(?:The|Mr|Ms) ') and regexp_matches(text, '^\s*(?:\d+\.\s*)?(?:(?:Mr|Mrs|Ms|Miss|Dr|Sir|Dame)\.?\s|The (?:Acting |Vice-)?(?:President|Chair|Secretary-General)\b)') then 'speaker'
  when not regexp_matches(text, '^(?:The|Mr|Ms) ') and regexp_matches(text, '^\s*(?:\d+\.\s*)?(?:(?:MR|MRS|MS|MISS|DR|SIR|DAME)\.?\s+[A-Z''’.\- ]{2,60}(?:\([^)]{2,60}\))?|THE (?:ACTING )?(?:PRESIDENT|CHAIRMAN))\s*(?:\([^)]*\))?\s*[:;]') then 'speaker' else 'continuation' end"""
_BLOCKS = r"""b as (select doc_id as doc, unnest(generate_series(0, len(p) - 1)) as seq, unnest(p) as text from (select doc_id, list_concat(['Agenda item 1 ' || coalesce(title, '')], string_split_regex(text, '\n+')) as p from documents where text is not null))"""


@query(
    "block_sections",
    rf"""with {_BLOCKS}, k as (select doc, seq, text, {_KIND} as kind from b), l as (select *, lag(kind) over (partition by doc order by seq) as last from k),
  g as (select *, sum(case when kind <> 'continuation' or last = 'stage' or last is null then 1 else 0 end) over (partition by doc order by seq) - 1 as section_id from l)
  select doc, cast(section_id as bigint) as section_id, case when arg_min(kind, seq) = 'continuation' then 'text' else arg_min(kind, seq) end as kind, min(seq) as position, count(*) as blocks from g group by doc, section_id""",
)
def block_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Typed sections of every document."""
    b = blocks(spark, sf)
    found = s.sectionise(b)
    n = found.select("doc", "section_id", "kind", F.col("position").cast("long").alias("position"))
    ends = found.select("doc", "section_id", "position")
    size = b.groupBy("doc").agg(F.count("*").alias("n"))
    from pyspark.sql import Window as W

    after = ends.join(size, "doc").select("doc", "section_id", (F.coalesce(F.lead("position").over(W.partitionBy("doc").orderBy("section_id")), F.col("n")) - F.col("position")).alias("blocks"))
    return n.join(after, ["doc", "section_id"])


@query(
    "meeting_items",
    rf"""with {_BLOCKS}, k as (select doc, seq, text, {_KIND} as kind from b), l as (select *, lag(kind) over (partition by doc order by seq) as last from k),
  g as (select *, sum(case when kind <> 'continuation' or last = 'stage' or last is null then 1 else 0 end) over (partition by doc order by seq) - 1 as section_id from l),
  s as (select doc, section_id, case when arg_min(kind, seq) = 'continuation' then 'text' else arg_min(kind, seq) end as kind, coalesce(string_agg(trim(text, ' '), ' ' order by seq) filter (trim(text, ' ') <> ''), '') as text from g group by all),
  i as (select *, sum(case when kind = 'agenda' then 1 else 0 end) over (partition by doc order by section_id) as item, regexp_replace(text, '^\s*\d+\.\s*', '') as bare from s),
  n as (select *, sum(case when kind in ('speaker', 'text') then 1 else 0 end) over (partition by doc, item order by section_id) as words,
    nullif(regexp_extract(bare, '(?s)^((?:(?i:Mr|Mrs|Ms|Miss|Dr|Sir|The)\b)[^:;]{{1,99}})[:;]\s*(.*)$', 1), '') as attribution, regexp_extract(bare, '(?s)^((?:(?i:Mr|Mrs|Ms|Miss|Dr|Sir|The)\b)[^:;]{{1,99}})[:;]\s*(.*)$', 2) as after from i),
  p as (select *, kind = 'speaker' or kind = 'text' and words = 1 as spoken, case when kind = 'speaker' then case when attribution is null then bare else after end else text end as body from n),
  q as (select *, sum(spoken::int) over (partition by doc, item order by section_id) as speech, min(case when kind = 'agenda' then text end) over (partition by doc, item) as title from p),
  said as (select doc, item, speech, string_agg(trim(body, ' '), ' ' order by section_id) filter (trim(body, ' ') <> '') as text from q where kind in ('speaker', 'text') group by all),
  e as (select doc, item, section_id, 'item' as element, 0 as rank, title, null as speaker, null as text from q where kind = 'agenda'
    union all select q.doc, q.item, section_id, 'speech', 1, title, case when kind = 'speaker' then trim(attribution, ' ') end, coalesce(said.text, '') from q join said using (doc, item, speech) where spoken
    union all select doc, item, section_id, 'direction', 1, title, null, text from q where kind = 'stage')
  select doc, cast(item as int) as item, element, cast(case when element <> 'item' then sum((element <> 'item')::int) over (partition by doc, item order by section_id, rank) - 1 end as int) as position_in_item,
    cast(case when element <> 'item' then sum((element <> 'item')::int) over (partition by doc order by section_id, rank) - 1 end as int) as position_in_document, title, speaker, cast(length(text) as int) as chars from e""",
)
def meeting_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items, speeches, directions and resolutions of every document (no text of these tables says that a draft was adopted; see recorded_votes)."""
    return s.items(s.sectionise(blocks(spark, sf))).select("doc", "item", "element", "position_in_item", "position_in_document", "title", "speaker", F.length("text").alias("chars"))


def ballot_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """A record of one vote for each resolution: the states (a fixed list) vote by their numbers; even ones print the lists after the adoption, others before it."""
    states = load(spark, sf, "member_states", "state_id", "member_state").agg(F.sort_array(F.collect_list(F.struct("state_id", "member_state"))).alias("states"))  # one row
    r = load(spark, sf, "resolutions", "id").crossJoin(F.broadcast(states))
    k = F.col("id")
    side = lambda n: F.filter("states", lambda x: (x["state_id"] + k) % 5 == n)
    names = lambda n: F.when(F.size(side(n)) == 0, "None").otherwise(F.array_join(F.transform(side(n), lambda x: x["member_state"]), ", "))
    block = lambda text, bold=False, italic=False: F.struct(text.alias("text"), F.lit(bold).alias("bold_start"), F.lit(italic).alias("all_italic"))
    lists = [block(F.concat(F.lit(f"{h}: "), names(n))) for n, h in enumerate(("In favour", "Against", "Abstaining"))]
    adopted = block(F.concat(F.lit("Draft resolution A/64/L."), k, F.lit(" was adopted by "), F.size(side(0)), F.lit(" votes to "), F.size(side(1)), F.lit(", with "), F.size(side(2)), F.lit(" abstentions (resolution 64/"), k, F.lit(").")), italic=True)
    head = [block(F.concat(F.lit("Agenda item "), k % 90 + 1, F.lit(" Question")), True), block(F.lit("The President: We shall vote now."), True)]
    taken = block(F.lit("A recorded vote was taken."), italic=True)
    text = F.when(k % 2 == 0, F.array(*head, adopted, *lists)).otherwise(F.array(*head, taken, *lists, adopted))
    return r.select(k.alias("doc"), F.posexplode(text).alias("seq", "x")).select("doc", "seq", "x.*")


_SIDES = "(select r.id as doc, m.member_state as country, case (m.state_id + r.id) % 5 when 0 then 'yes' when 1 then 'no' when 2 then 'abstain' end as position from resolutions r, member_states m)"


@query("recorded_votes", f"select doc, 'A/64/L.' || doc as draft_symbol, '64/' || doc as adopted_symbol, 'recorded' as vote_type, cast(count(*) filter (position = 'yes') as int) as yes, cast(count(*) filter (position = 'no') as int) as no, cast(count(*) filter (position = 'abstain') as int) as abstain from {_SIDES} group by doc")
def recorded_votes(spark: SparkSession, sf: str) -> DataFrame:
    """What was voted on every resolution, from the records of the votes."""
    found = s.items(s.sectionise(ballot_blocks(spark, sf))).where("element = 'resolution'")
    return found.select("doc", "draft_symbol", "adopted_symbol", "vote_type", "yes", "no", "abstain")


@query("country_votes", f"select doc, country, position from {_SIDES} where position is not null")
def country_votes(spark: SparkSession, sf: str) -> DataFrame:
    """How every state voted."""
    found = s.items(s.sectionise(ballot_blocks(spark, sf))).where("element = 'resolution'")
    return found.select("doc", F.explode("votes").alias("v")).select("doc", "v.country", "v.position")


@query("reading_order", "with e as (select user_id, event_id, value as x0, (event_id * 7919) % 1000 as y0, avg((value >= 50)::int) over (partition by user_id) >= 0.2 as two from events) select event_id, row_number() over (partition by user_id order by case when two and x0 >= 50 then 1 else 0 end, y0, x0) - 1 as seq from e")
def reading_order(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of a page in columns."""
    e = load(spark, sf, "events", "event_id", "user_id", "value")
    b = e.select("event_id", F.col("user_id").alias("doc"), F.lit(1).alias("page_num"), F.col("value").alias("x0"), ((F.col("event_id") * 7919) % 1000).alias("y0"), F.lit(100.0).alias("page_width"))
    return s.reading_order(b).select("event_id", F.col("seq").cast("long").alias("seq"))


@query("clean_blocks", r"""select doc_id, count(*) as kept from (select doc_id, unnest(string_split_regex(text, '\n')) as line from documents where text is not null) where not regexp_matches(line, '(?i)^\s*(?:|\d{1,4}|page \d+|\d{2}-\d{5}(?:\s*\([a-z]\))?|\d{2}-\d{5}\s+\d+/\d+|\*\d+\*|this record contains .*|corrections .* should be (?:submitted|sent).*|(?:general assembly|security council)\s+[as]/\S+|[as]/(?:\d+/)?pv\.\d+)\s*$') group by 1""")
def clean_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """P11 P12."""
    d = load(spark, sf, "documents", "doc_id", "text").where(F.col("text").isNotNull())
    b = d.select("doc_id", F.explode(F.split("text", "\n")).alias("text"), F.lit(400.0).alias("y0"), F.lit(0.0).alias("page_height"))
    return s.clean_blocks(b).groupBy("doc_id").agg(F.count("*").alias("kept"))


@query("best_source", "select user_id, arg_max(event_type, value * 1000000000 + event_id) as event_type from events group by 1")
def best_source(spark: SparkSession, sf: str) -> DataFrame:
    """The version with the best score."""
    e = load(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    return s.best_source(e.withColumnsRenamed({"user_id": "doc", "value": "score", "event_id": "priority"})).select(F.col("doc").alias("user_id"), "event_type")


@query("html_paragraphs", r"""select doc_id, count(*) as paragraphs, cast(sum(length(trim(x))) as bigint) as chars from (select doc_id, unnest(string_split_regex(text, '\n+')) as x from documents where text is not null) where trim(x, E' \t\n\r\x0b\x0c  　​﻿') <> '' group by 1""")
def html_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs of pages, here of the documents set as HTML."""
    d = load(spark, sf, "documents", "doc_id", "text").where(F.col("text").isNotNull())
    esc = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = d.select("doc_id", F.concat(F.lit("<html><head><style>p{}</style></head><body><p>"), F.regexp_replace(esc, r"\n+", "</p><p>"), F.lit("</p></body></html>")).alias("html"))
    b = html_blocks(page, "doc_id", "html")
    return b.select("doc_id", F.trim(s.block_text("segments")).alias("x")).groupBy("doc_id").agg(F.count("*").alias("paragraphs"), F.sum(F.length("x")).alias("chars"))


@query("html_styles", r"""select doc_id, cast(sum(length(trim(x))) as bigint) as bold, cast(sum(length(trim(x)) * 2) as bigint) as italic, cast(sum(length(trim(x)) * 4) as bigint) as chars from (select doc_id, unnest(string_split_regex(text, '\n+')) as x from documents where text is not null) where trim(x, E' \t\n\r\x0b\x0c  　​﻿') <> '' group by 1""")
def html_styles(spark: SparkSession, sf: str) -> DataFrame:
    """Styled letters of pages: every paragraph of the documents stands four times, plain, bold, and in two ways italic."""
    d = load(spark, sf, "documents", "doc_id", "text").where(F.col("text").isNotNull())
    esc = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.array_join(F.transform(F.split(esc, r"\n+"), lambda x: F.concat(F.lit("<p>"), x, F.lit("<SPAN style='color:red; font-weight: 700'>"), x, F.lit("</SPAN> <em>"), x, F.lit("</em><span style=\"font-style:oblique\"><!-- <b> -->"), x, F.lit("</span></p><script>if (a < b) x('<b>')</script>"))), "")
    b = html_blocks(d.select("doc_id", page.alias("html")), "doc_id", "html").select("doc_id", F.explode("segments").alias("x")).select("doc_id", "x.*")
    n = F.length(F.trim("text"))
    return b.groupBy("doc_id").agg(F.sum(F.when(F.col("bold"), n)).alias("bold"), F.sum(F.when(F.col("italic"), n)).alias("italic"), F.sum(n).alias("chars"))


@query("segment_styles", "select doc_id, len(text) > 1000 as bold, lang = 'en' as italic from documents where text is not null and trim(text) <> ''")
def segment_styles(spark: SparkSession, sf: str) -> DataFrame:
    """A1 to A4: styles of segments."""
    d = load(spark, sf, "documents", "doc_id", "lang", "text").where(F.col("text").isNotNull() & (F.trim("text") != ""))
    b = d.select("doc_id", F.array(F.struct(F.lit("  ").alias("text"), F.lit(False).alias("bold"), F.lit(False).alias("italic")), F.struct(F.lit("x").alias("text"), (F.length("text") > 1000).alias("bold"), (F.col("lang") == "en").alias("italic"))).alias("segments"))
    return b.select("doc_id", s.first_shown("segments", "bold").alias("bold"), s.all_shown("segments", "italic").alias("italic"))
