"""Queries on the text functions, each over the whole table whose texts they read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.symbols import canonical_sql, canonical_symbol
from ..runtime import cut, join_hot
from ..tables import load
from . import Registry

query = Registry()

_WORDS = r"list_filter(string_split_regex(trim({c}), '\s+'), lambda w: w <> '')"
_TOKENS = rf"list_filter(string_split_regex(text, '[ \t\n\r\f\v]+'), lambda w: regexp_matches(w, '[A-Za-z]'))"


@query(
    "ocr_quality",
    f"""with k as (select doc_id, {_TOKENS} as toks from documents where text is not null), n as (select doc_id, cast(len(toks) as int) as alpha, cast(len(list_filter(toks, lambda w: length(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= 2 and 2 * length(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= length(w))) as int) as good from k)
  select doc_id, alpha, good, case when alpha < 50 then 0.0e0 else round(good / alpha, 4) end as score from n""",
)
def ocr_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens with letters, word-like ones, and the score that they give."""
    alpha, good = t.wordlike_counts(F.col("text"))
    d = load(spark, sf, "documents", "doc_id", "text").where(F.col("text").isNotNull()).select("doc_id", alpha.alias("alpha"), good.alias("good"))
    return d.select("*", t.quality_of(F.col("alpha"), F.col("good")).alias("score"))


@query("corpus_quality", f"with k as (select lang, {_TOKENS} as toks from documents where text is not null) select lang, cast(sum(len(list_filter(toks, lambda w: length(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= 2 and 2 * length(regexp_replace(w, '[^A-Za-z]', '', 'g')) >= length(w)))) as bigint) as good, cast(sum(len(toks)) as bigint) as alpha from k group by 1")
def corpus_quality(spark: SparkSession, sf: str) -> DataFrame:
    """G24."""
    alpha, good = t.wordlike_counts(F.col("text"))
    return load(spark, sf, "documents", "lang", "text").where(F.col("text").isNotNull()).groupBy("lang").agg(F.sum(good).alias("good"), F.sum(alpha).alias("alpha"))


@query("repair_hyphenation", r"select id, md5(regexp_replace(text, '([A-Za-z])-[ \t\n]+([a-z])', '\1\2', 'g')) as repaired, length(text) - length(regexp_replace(text, '([A-Za-z])-[ \t\n]+([a-z])', '\1\2', 'g')) as removed from speeches")
def repair_hyphenation(spark: SparkSession, sf: str) -> DataFrame:
    """T2."""
    r = t.repair_hyphenation(F.col("text"))
    return load(spark, sf, "speeches", "id", "text").select("id", F.md5(r.cast("binary")).alias("repaired"), (F.length("text") - F.length(r)).cast("long").alias("removed"))


@query(
    "record_symbols",
    r"""select doc_id, nullif(regexp_extract(symbol, '\b([AS]/(?:\d+/)?PV\.\d+)\b', 1), '') as symbol, try_cast(regexp_extract(symbol, '^A/(\d+)/', 1) as int) as session, try_cast(regexp_extract(symbol, 'PV\.(\d+)', 1) as int) as number,
  case when starts_with(symbol, 'A/') then 'GA' when starts_with(symbol, 'S/') then 'SC' end as body, replace(symbol, '/', '_') as file_key, regexp_full_match(symbol, '[AS]/(\d+/)?PV\.\d+') as valid from documents""",
)
def record_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """S2 T5 T6 T8 T11 T40 P20."""
    s = F.col("symbol")
    return load(spark, sf, "documents", "doc_id", "symbol").select("doc_id", t.record_symbol(s).alias("symbol"), t.session_of(s).alias("session"), t.number_of(s).alias("number"), t.body_of(s).alias("body"), t.file_key(s).alias("file_key"), s.rlike(r"^[AS]/(\d+/)?PV\.\d+$").alias("valid"))


_DATE = r"regexp_extract(text, '\b(\d{1,2}|I) (January|February|March|April|May|June|July|August|September|October|November|December) (\d{4})\b', 0)"


@query("spelled_dates", f"select doc_id, case when year(d) between 1945 and 2100 then cast(d as varchar) end as date from (select doc_id, try_strptime(regexp_replace({_DATE}, '^I ', '1 '), '%-d %B %Y')::date as d from documents where text is not null)")
def spelled_dates(spark: SparkSession, sf: str) -> DataFrame:
    """D2 D8."""
    return load(spark, sf, "documents", "doc_id", "text").where(F.col("text").isNotNull()).select("doc_id", t.spelled_date(F.col("text")).cast("string").alias("date"))


@query(
    "mention_symbols",
    r"""with m as (select id, unnest(list_concat(regexp_extract_all(text, '(?i)\b(A/RES/\d+/\d+[A-Z]?)', 1), regexp_extract_all(text, '(?i)\b(S/RES/\d+)\b', 1), regexp_extract_all(text, '(?i)\b((?:A/(?:C\.\d/)?\d+|S/\d{4})/(?:L\.)?\d+(?:/REV\.\d+)?)\b', 1),
  list_transform(regexp_extract_all(text, '(?i)\bresolution (\d+/\d+)\b', 1), lambda x: 'A/RES/' || x), list_transform(regexp_extract_all(text, '(?i)\bresolution (\d{3,4})(?: \(\d{4}\))?(?:[^\d/]|$)', 1), lambda x: 'S/RES/' || x))) as s from speeches)
  select distinct id, upper(s) as symbol from m""",
)
def mention_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """The symbols that each speech mentions."""
    return load(spark, sf, "speeches", "id", "text").select("id", F.explode(t.mentions(F.col("text"))).alias("symbol"))


@query(
    "symbol_index_lookup",
    f"""with keys as (select {canonical_sql("draft_symbol")} as k, id, 1 as rank from resolutions union all select {canonical_sql("adopted_symbol")}, id, 0 from resolutions),
  idx as (select k, arg_min(id, rank * 1000000000 + id) as resolution from keys where k is not null group by k)
  select m.id, i.resolution from speech_resolution_mentions m left join idx i on i.k = {canonical_sql("m.cited_symbol")}""",
)
def symbol_index_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Any way of writing a symbol finds its resolution; adopted ones before drafts, then the lowest id."""
    r = load(spark, sf, "resolutions", "id", "draft_symbol", "adopted_symbol")
    keys = r.select("id", F.explode(F.array(F.struct(canonical_symbol(F.col("adopted_symbol")).alias("k"), F.lit(0).alias("rank")), F.struct(canonical_symbol(F.col("draft_symbol")).alias("k"), F.lit(1).alias("rank")))).alias("x"))
    idx = keys.where(F.col("x.k").isNotNull()).groupBy(F.col("x.k").alias("k")).agg(F.min_by("id", F.struct("x.rank", "id")).alias("resolution"))
    m = load(spark, sf, "speech_resolution_mentions", "id", "cited_symbol").withColumn("k", canonical_symbol(F.col("cited_symbol")))
    return join_hot(cut(m.select("id", "k")), idx, "k").select("id", "resolution")  # one symbol may hold a third of the citations


@query("name_forms", r"""with s as (select distinct name from sc_representatives), r as (select name, case when contains(name, ',') then trim(concat_ws(' ', trim(regexp_extract(name, ',\s*(.*)$', 1)), trim(regexp_extract(name, '^([^,]*)', 1)))) else trim(name) end as turned from s) select name, turned, upper(regexp_extract(turned, '(\S+)$', 1)) as last_word from r""")
def name_forms(spark: SparkSession, sf: str) -> DataFrame:
    """T19."""
    n = load(spark, sf, "sc_representatives", "name").distinct().withColumn("turned", t.normalise_name(F.col("name")))
    return n.select("name", "turned", F.upper(F.regexp_extract("turned", r"(\S+)$", 1)).alias("last_word"))


@query("topic_words", r"""select word, count(*) as n, count(distinct doc_id) as documents from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) as word from documents) group by 1""")
def topic_words(spark: SparkSession, sf: str) -> DataFrame:
    """The words of the topic models."""
    d = load(spark, sf, "documents", "doc_id", "text")
    w = d.select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{3,})"), F.lit(1))).alias("word"))
    return w.groupBy("word").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("documents"))


@query("on_behalf", r"""select id, nullif(trim(regexp_extract(left(text, 500), '(?i)on\s+behalf\s+of\s+(?:the\s+)?([\p{L}\p{N}_\s,\-]+?)(?:\s*[.,;]|\s+I\b)', 1), ' '), '') as party from speeches""")
def on_behalf(spark: SparkSession, sf: str) -> DataFrame:
    """Whom the speeches speak for."""
    return load(spark, sf, "speeches", "id", "text").select("id", t.on_behalf_of(F.col("text")).alias("party"))


@query(
    "validation_errors",
    r"""with r as (select doc_id, case when not regexp_full_match(symbol, '[AS]/(\d+/)?PV\.\d+') then 'symbol' end as a, case when date is null or year(date) not between 1945 and 2100 then 'date' end as b, case when body <> 'SC' and coalesce(session, 0) <= 0 then 'session' end as c, case when coalesce(trim(text), '') = '' then 'text' end as d from documents)
  select doc_id, field from (select doc_id, unnest([a, b, c, d]) as field from r) where field is not null""",
)
def validation_errors(spark: SparkSession, sf: str) -> DataFrame:
    """P20 to P25: the fields of each record that break a rule."""
    d = load(spark, sf, "documents", "doc_id", "symbol", "date", "body", "session", "text")
    rules = {
        "symbol": ~F.col("symbol").rlike(r"^[AS]/(\d+/)?PV\.\d+$"),
        "date": F.col("date").isNull() | ~F.year("date").between(1945, 2100),
        "session": (F.col("body") != "SC") & (F.coalesce("session", F.lit(0)) <= 0),
        "text": F.coalesce(F.trim("text"), F.lit("")) == "",
    }
    return d.select("doc_id", F.explode(F.array_compact(F.array(*(F.when(c, f) for f, c in rules.items())))).alias("field"))


@query(
    "draft_symbol_checks",
    r"""select id, contains(draft_symbol, '/') and regexp_matches(draft_symbol, '\d') as plausible, regexp_full_match(draft_symbol, 'A/(C\.\d/)?\d+/L\.\d+(/Rev\.\d+)?|S/\d{4}/\d+|[IVXLC]+( [A-Z])?') as valid from resolutions""",
)
def draft_symbol_checks(spark: SparkSession, sf: str) -> DataFrame:
    """P15 P23."""
    d = F.col("draft_symbol")
    return load(spark, sf, "resolutions", "id", "draft_symbol").select("id", (d.contains("/") & d.rlike(r"\d")).alias("plausible"), d.rlike(r"^(?:A/(C\.\d/)?\d+/L\.\d+(/Rev\.\d+)?|S/\d{4}/\d+|[IVXLC]+( [A-Z])?)$").alias("valid"))


@query("plausible_dates", "select doc_id, year(date) - (1945 + session) between 0 and 2 as extracted, abs(year(date) - (1945 + session)) <= 2 as listed from documents where session is not null")
def plausible_dates(spark: SparkSession, sf: str) -> DataFrame:
    """P19 D1 D5."""
    d = load(spark, sf, "documents", "doc_id", "date", "session").where(F.col("session").isNotNull())
    return d.select("doc_id", t.plausible_year(F.col("date"), F.col("session")).alias("extracted"), t.plausible_year(F.col("date"), F.col("session"), 2, 2).alias("listed"))


_ORG = r"(?i)\b(union|organi[sz]ation|league|council|committee|agency|office|secretariat|federation|bureau|bank|fund|court|order|group|department|commission|programme)\b"


@query("organizations", rf"select speaker.country as country, count(*) as n, regexp_matches(speaker.country, '{_ORG}') or regexp_full_match(speaker.country, '[A-Z]{{3,6}}') as organization from speeches where speaker.country is not null group by all")
def organizations(spark: SparkSession, sf: str) -> DataFrame:
    """P16."""
    s = load(spark, sf, "speeches").select("speaker.country").where(F.col("country").isNotNull())
    return s.groupBy("country").agg(F.count("*").alias("n"), F.first(t.is_organization(F.col("country"))).alias("organization"))


@query("junk_names", r"""with f as (select id, trim(name) as s from countries) select id, flag from (select id, unnest([case when s is null or length(s) < 3 then 'short' end, case when not regexp_matches(s, '^\pL') then 'starts_non_letter' end, case when regexp_matches(s, '\d') then 'has_digit' end, case when length(s) > 100 then 'long' end, case when lower(s) in ('n/a', 'none', 'unknown', '-', '?', 'tbd', 'various') then 'sentinel' end]) as flag from f) where flag is not null""")
def junk_names(spark: SparkSession, sf: str) -> DataFrame:
    """P17 P18."""
    return load(spark, sf, "countries", "id", "name").select("id", F.explode(t.junk_flags(F.col("name"))).alias("flag"))


@query("case_insensitive_states", "select c.id, min(m.state_id) as state_id from countries c join member_states m on lower(c.name) = lower(m.member_state) group by 1")
def case_insensitive_states(spark: SparkSession, sf: str) -> DataFrame:
    """P9 J31."""
    c = load(spark, sf, "countries", "id", "name").withColumn("k", F.lower("name"))
    m = load(spark, sf, "member_states", "state_id", "member_state").withColumn("k", F.lower("member_state"))
    return c.join(m, "k").groupBy("id").agg(F.min("state_id").alias("state_id"))


@query("state_names", "select state_id, unnest(string_split(other_names, '|')) as name from member_states where other_names is not null")
def state_names(spark: SparkSession, sf: str) -> DataFrame:
    """Pipe lists."""
    return load(spark, sf, "member_states", "state_id", "other_names").where(F.col("other_names").isNotNull()).select("state_id", F.explode(F.split("other_names", r"\|")).alias("name"))


@query("prop_values", "select event_id, try_cast(json_extract_string(props, '$.k') as int) as k from events")
def prop_values(spark: SparkSession, sf: str) -> DataFrame:
    """A value out of JSON."""
    return load(spark, sf, "events", "event_id", "props").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("subject_category", "select p_partkey, case when p_name like '%ring%' then 'round' when p_name like '%bolt%' then 'long' when upper(p_type) like '%LARGE%' then 'big' else 'Uncategorized' end as category from part")
def subject_category(spark: SparkSession, sf: str) -> DataFrame:
    """The first rule that fits; the rules are a small table with priorities."""
    rules = spark.createDataFrame([(0, "p_name", "ring", "round"), (1, "p_name", "bolt", "long"), (2, "p_type", "LARGE", "big")], "priority int, field string, word string, category string")
    p = load(spark, sf, "part", "p_partkey", "p_name", "p_type")
    tags = p.select("p_partkey", F.explode(F.array(F.struct(F.lit("p_name").alias("field"), F.col("p_name").alias("tag")), F.struct(F.lit("p_type").alias("field"), F.upper("p_type").alias("tag")))).alias("x")).select("p_partkey", "x.*")
    hit = tags.join(F.broadcast(rules), tags["field"] == rules["field"]).where(F.col("tag").contains(F.col("word")))
    best = hit.groupBy("p_partkey").agg(F.min_by("category", "priority").alias("category"))
    return p.select("p_partkey").join(best, "p_partkey", "left").select("p_partkey", F.coalesce("category", F.lit("Uncategorized")).alias("category"))


@query(
    "cover_metadata",
    r"""select doc_id, symbol, case when body = 'GA' then cast(regexp_extract(symbol, '^A/(\d+)/', 1) as int) else 47 end as session, cast(regexp_extract(symbol, 'PV\.(\d+)', 1) as int) as meeting_number, cast(date as varchar) as date, case when doc_id % 3 > 0 then 'New York' else 'Geneva' end as location, 'Mr. Baro' as president, 'NATION_' || (doc_id % 25) as country, body
  from documents where regexp_full_match(symbol, '(?:A/\d+|S)/PV\.\d+') and year(date) between 1945 and 2100""",
)
def cover_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """What covers say that are written for all records."""
    d = load(spark, sf, "documents", "doc_id", "symbol", "date").where(F.col("symbol").rlike(r"^(?:A/\d+|S)/PV\.\d+$") & F.year("date").between(1945, 2100))
    cover = F.concat(F.lit("Official Records  "), "symbol", F.lit("  Forty-seventh year\nMonday, "), F.date_format("date", "d MMMM yyyy"), F.lit(", 3 p.m.\n"), F.when(F.col("doc_id") % 3 > 0, "NEW YORK").otherwise("Geneva"), F.lit("\nPresident: MR. BARO"), F.when(F.col("doc_id") % 2 == 0, " ........ ").otherwise(" "), F.lit("(NATION_"), F.col("doc_id") % 25, F.lit(")"))
    m = d.select("doc_id", t.record_metadata(cover).alias("m")).select("doc_id", "m.*")
    return m.select("doc_id", "symbol", "session", "meeting_number", F.col("date").cast("string").alias("date"), "location", F.col("president.name").alias("president"), F.col("president.country").alias("country"), "body")
