"""Queries on roll calls, sponsors and coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ballots import BALLOTS_SQL, SPONSORS_SQL, ballots, sponsors
from ..operators.graph import components, edge_weights, network_stats, pagerank_rounds, ranked_components
from ..operators.pairs import agreement, pairs_in_group
from ..runtime import join_hot
from ..tables import load
from . import Registry

query = Registry()

PAIRS_SQL = """pairs as (
  select a.country_id as country_id_a, b.country_id as country_id_b, a.yr, avg(case when a.vote_position = b.vote_position then 1.0e0 else 0.0e0 end) as agreement_rate, count(*) as n_votes
  from ballots a join ballots b on a.vote_id = b.vote_id and a.yr = b.yr and a.country_id < b.country_id
  where a.vote_position in ('yes', 'no', 'abstain') and b.vote_position in ('yes', 'no', 'abstain') group by all)"""


@query("alignment_series", f"with {BALLOTS_SQL}, {PAIRS_SQL} select country_id_a, country_id_b, yr, round(agreement_rate, 6) as agreement_rate, n_votes from pairs where n_votes >= 10")
def alignment_series(spark: SparkSession, sf: str) -> DataFrame:
    """How often two states agree, by pair and year."""
    return agreement(ballots(spark, sf)).withColumn("agreement_rate", F.round("agreement_rate", 6))


@query(
    "alignment_series_compat",
    f"""with {BALLOTS_SQL} select least(a.country_id, b.country_id) as country_id_a, greatest(a.country_id, b.country_id) as country_id_b, a.yr,
  round(avg(case when a.vote_position = b.vote_position then 1.0e0 else 0.0e0 end), 6) as agreement_rate, count(*) as n_votes
  from ballots a join ballots b on a.vote_id = b.vote_id and a.yr = b.yr and a.country_id != b.country_id where a.vote_position != 'non_voting' and b.vote_position != 'non_voting' group by all having count(*) >= 10""",
)
def alignment_series_compat(spark: SparkSession, sf: str) -> DataFrame:
    """As the published series counts, where each common vote comes twice."""
    p = pairs_in_group(ballots(spark, sf).where(F.col("vote_position") != "non_voting"), ["vote_id", "yr"], "country_id", "vote_position")
    agg = p.groupBy(F.col("a").alias("country_id_a"), F.col("b").alias("country_id_b"), "yr").agg(F.round(F.avg(F.when(F.col("va") == F.col("vb"), 1.0).otherwise(0.0)), 6).alias("agreement_rate"), (2 * F.count("*")).alias("n_votes"))
    return agg.where(F.col("n_votes") >= 10)


@query("voting_bloc_pairs", f"with {BALLOTS_SQL}, {PAIRS_SQL} select country_id_a, country_id_b, yr, round(agreement_rate, 6) as agreement_rate, n_votes from pairs where n_votes >= 30")
def voting_bloc_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The pairs of a year that share votes enough for a bloc."""
    return agreement(ballots(spark, sf), least=30).withColumn("agreement_rate", F.round("agreement_rate", 6))


_WINDOW = """windowed as (select b.country_id, b.vote_id, b.vote_position, c.y as centre from ballots b, (select unnest(generate_series(-2, 2)) as d) k, lateral (select cast(b.yr + k.d as int) as y) c
  where c.y in (select distinct yr from ballots)),
wpairs as (select a.country_id as country_id_a, b.country_id as country_id_b, a.centre, avg(case when a.vote_position = b.vote_position then 1.0e0 else 0.0e0 end) as agreement_rate, count(*) as n_votes
  from windowed a join windowed b on a.vote_id = b.vote_id and a.centre = b.centre and a.country_id < b.country_id group by all having count(*) >= 30)"""


def windowed(spark: SparkSession, sf: str, least: int = 30) -> DataFrame:
    """Pairs over the five years around each year: additive counts of single years are summed over the window, so the pairs are formed once."""
    b = ballots(spark, sf)
    p = pairs_in_group(b, ["vote_id", "yr"], "country_id", "vote_position")
    yearly = p.groupBy("a", "b", "yr").agg(F.count_if(F.col("va") == F.col("vb")).alias("same"), F.count("*").alias("n"))
    years = yearly.select("yr").distinct().withColumnRenamed("yr", "centre")  # a handful of years
    spread = yearly.withColumn("centre", F.explode(F.sequence(F.col("yr") - 2, F.col("yr") + 2))).join(F.broadcast(years), "centre")
    w = spread.groupBy(F.col("a").alias("country_id_a"), F.col("b").alias("country_id_b"), "centre").agg((F.sum("same") / F.sum("n")).alias("agreement_rate"), F.sum("n").alias("n_votes"))
    return w.where(F.col("n_votes") >= least)


@query(
    "bloc_window_pairs",
    f"""with {BALLOTS_SQL}, yearly as (select a.country_id as x, b.country_id as y, a.yr, count(*) filter (where a.vote_position = b.vote_position) as same, count(*) as n
  from ballots a join ballots b on a.vote_id = b.vote_id and a.yr = b.yr and a.country_id < b.country_id group by all)
  select x as country_id_a, y as country_id_b, c.yr as centre, round(sum(same) / sum(n), 6) as agreement_rate, cast(sum(n) as bigint) as n_votes
  from yearly join (select distinct yr from ballots) c on yearly.yr between c.yr - 2 and c.yr + 2 group by all having sum(n) >= 30""",
)
def bloc_window_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Agreement over a moving window of five years."""
    return windowed(spark, sf).withColumn("agreement_rate", F.round("agreement_rate", 6))


#: On the order tables agreement is far lower than in real roll calls.
BLOC_THRESHOLD = 0.345


@query(
    "voting_blocs",
    f"""with recursive {BALLOTS_SQL}, yearly as (select a.country_id as x, b.country_id as y, a.yr, count(*) filter (where a.vote_position = b.vote_position) as same, count(*) as n
  from ballots a join ballots b on a.vote_id = b.vote_id and a.yr = b.yr and a.country_id < b.country_id group by all),
  w as (select x, y, c.yr, sum(same) / sum(n) as rate from yearly join (select distinct yr from ballots) c on yearly.yr between c.yr - 2 and c.yr + 2 group by all having sum(n) >= 30),
  e as (select yr, x as a, y as b from w where rate >= {BLOC_THRESHOLD} union all select yr, y, x from w where rate >= {BLOC_THRESHOLD}),
  nodes as (select distinct yr, x as node from w union select distinct yr, y from w),
  reach as (select yr, node, node as r from nodes union select reach.yr, e.b, reach.r from reach join e on e.yr = reach.yr and e.a = reach.node),
  comp as (select yr, node, min(r) as component from reach group by all),
  sizes as (select yr, component, row_number() over (partition by yr order by count(*) desc, component) - 1 as bloc_index from comp group by yr, component)
  select yr, node as country_id, cast(bloc_index as int) as bloc_index from comp join sizes using (yr, component)""",
)
def voting_blocs(spark: SparkSession, sf: str) -> DataFrame:
    """GR1 W8: blocs of states that agree, by year."""
    w = windowed(spark, sf).withColumnRenamed("centre", "yr")
    nodes = w.select("yr", F.explode(F.array("country_id_a", "country_id_b")).alias("node"))
    edges = w.where(F.col("agreement_rate") >= BLOC_THRESHOLD).select("yr", F.col("country_id_a").alias("a"), F.col("country_id_b").alias("b"))
    return ranked_components(components(nodes, edges, ["yr"]), ["yr"]).select("yr", F.col("node").alias("country_id"), F.col("bloc_index").cast("int").alias("bloc_index"))


@query("available_years", f"with {BALLOTS_SQL} select distinct yr from ballots")
def available_years(spark: SparkSession, sf: str) -> DataFrame:
    """G7."""
    return load(spark, sf, "lineitem", "l_shipdate").select(F.year("l_shipdate").alias("yr")).distinct()


@query("year_stats", f"with {BALLOTS_SQL} select vote_position, min(yr) as first_yr, max(yr) as last_yr, count(distinct country_id) as countries, count(distinct (country_id, yr)) as country_years from ballots group by 1")
def year_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges and distinct counts, also of tuples."""
    return ballots(spark, sf).groupBy("vote_position").agg(F.min("yr").alias("first_yr"), F.max("yr").alias("last_yr"), F.countDistinct("country_id").alias("countries"), F.countDistinct("country_id", "yr").alias("country_years"))


@query(
    "coverage_report",
    """select d.body, d.session, count(*) as documents, count(case when s.n > 0 then 1 end) as with_speeches, coalesce(cast(sum(s.n) as bigint), 0) as speeches, round(100.0e0 * count(case when s.n > 0 then 1 end) / count(*), 4) as pct
  from documents d left join (select document_id, count(*) as n from speeches group by 1) s on s.document_id = d.doc_id group by 1, 2""",
)
def coverage_report(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with and without speeches, by body and session."""
    n = load(spark, sf, "speeches", "document_id").groupBy("document_id").agg(F.count("*").alias("n"))
    d = load(spark, sf, "documents", "doc_id", "body", "session").join(n.withColumnRenamed("document_id", "doc_id"), "doc_id", "left")
    have = F.count(F.when(F.col("n") > 0, 1))
    return d.groupBy("body", "session").agg(F.count("*").alias("documents"), have.alias("with_speeches"), F.coalesce(F.sum("n"), F.lit(0)).alias("speeches"), F.round(100.0 * have / F.count("*"), 4).alias("pct"))


@query("coverage_rollup", "select body, lang, grouping(body) * 2 + grouping(lang) as level, count(*) as documents, count(*) filter (where ods_used) as from_html from documents group by rollup(body, lang)")
def coverage_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Subtotals."""
    d = load(spark, sf, "documents", "body", "lang", "ods_used")
    return d.rollup("body", "lang").agg(F.grouping_id().cast("long").alias("level"), F.count("*").alias("documents"), F.count_if("ods_used").alias("from_html"))


_ISSUES = {"issue_me": "%EAST%", "issue_nu": "%PROMO%", "issue_co": "%ECONOMY%", "issue_hr": "%STANDARD%", "issue_ec": "%LARGE%", "issue_di": "%SMALL%"}


@query("issue_counts", "select p_size, " + ", ".join(f"count(*) filter (where upper(p_type) like '{v}') as {k}" for k, v in _ISSUES.items()) + ", count(*) as total from part group by 1")
def issue_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Filtered counts."""
    p = load(spark, sf, "part", "p_size", "p_type")
    return p.groupBy("p_size").agg(*(F.count_if(F.upper("p_type").like(v)).alias(k) for k, v in _ISSUES.items()), F.count("*").alias("total"))


@query(
    "sponsor_features",
    f"""with {SPONSORS_SQL}, s as (select resolution_id, count(*) as n_sponsors, bool_or(country_id = 1) as us, bool_or(country_id = 2) as ru, bool_or(country_id = 3) as cn from sponsors group by 1)
  select o_orderkey as resolution_id, coalesce(n_sponsors, 0) as n_sponsors, coalesce(us, false) as us_sponsored, coalesce(ru, false) as ru_sponsored, coalesce(cn, false) as cn_sponsored from orders left join s on s.resolution_id = o_orderkey""",
)
def sponsor_features(spark: SparkSession, sf: str) -> DataFrame:
    """A summary of each resolution's sponsors, false where there are none."""
    s = sponsors(spark, sf).groupBy("resolution_id").agg(F.count("*").alias("n_sponsors"), *(F.bool_or(F.col("country_id") == k).alias(f"{c}_sponsored") for k, c in ((1, "us"), (2, "ru"), (3, "cn"))))
    out = load(spark, sf, "orders", "o_orderkey").withColumnRenamed("o_orderkey", "resolution_id").join(s, "resolution_id", "left")
    return out.select("resolution_id", F.coalesce("n_sponsors", F.lit(0)).alias("n_sponsors"), *(F.coalesce(f"{c}_sponsored", F.lit(False)).alias(f"{c}_sponsored") for c in ("us", "ru", "cn")))


@query(
    "vote_features",
    f"""with {BALLOTS_SQL}, means as (select country_id, yr, avg(case vote_position when 'yes' then 1.0e0 when 'no' then -1.0e0 else 0.0e0 end) as ideal_point from ballots group by all)
  select b.country_id, b.yr, count(*) as n, round(min(m.ideal_point), 6) as ideal_point, count(*) filter (where b.vote_position = 'yes') as yes from ballots b left join means m on m.country_id = b.country_id and m.yr = b.yr - 1 group by all""",
)
def vote_features(spark: SparkSession, sf: str) -> DataFrame:
    """Ballots with last year's position of the country, joined on a computed key."""
    b = ballots(spark, sf)
    value = F.when(F.col("vote_position") == "yes", 1.0).when(F.col("vote_position") == "no", -1.0).otherwise(0.0)
    yearly = b.groupBy("country_id", "yr").agg(F.count("*").alias("n"), F.count_if(F.col("vote_position") == "yes").alias("yes"), F.avg(value).alias("mean"))
    means = yearly.select("country_id", (F.col("yr") + 1).alias("yr"), F.col("mean").alias("ideal_point"))
    return yearly.drop("mean").join(means, ["country_id", "yr"], "left").withColumn("ideal_point", F.round("ideal_point", 6))


@query(
    "usage_report",
    """select n_name, coalesce(c.n, 0) as customers, coalesce(s.n, 0) as suppliers, coalesce(c.n, 0) + coalesce(s.n, 0) as total from nation
  left join (select c_nationkey, count(*) as n from customer group by 1) c on c_nationkey = n_nationkey left join (select s_nationkey, count(*) as n from supplier group by 1) s on s_nationkey = n_nationkey where c.n is not null or s.n is not null""",
)
def usage_report(spark: SparkSession, sf: str) -> DataFrame:
    """Two aggregates joined to one list."""
    c = load(spark, sf, "customer", "c_nationkey").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("c"))
    s = load(spark, sf, "supplier", "s_nationkey").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("s"))
    out = load(spark, sf, "nation", "n_nationkey", "n_name").join(c, "n_nationkey", "left").join(s, "n_nationkey", "left").where(F.col("c").isNotNull() | F.col("s").isNotNull())
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    return out.select("n_name", zero("c").alias("customers"), zero("s").alias("suppliers"), (zero("c") + zero("s")).alias("total")).orderBy(F.col("total").desc(), "n_name")


@query("semi_recorded", "select o_orderkey, o_orderstatus from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')")
def semi_recorded(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a partner."""
    r = load(spark, sf, "lineitem", "l_orderkey", "l_returnflag").where(F.col("l_returnflag") == "R")
    return load(spark, sf, "orders", "o_orderkey", "o_orderstatus").join(r, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")


@query("anti_pending", "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')")
def anti_pending(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a partner."""
    r = load(spark, sf, "lineitem", "l_orderkey", "l_returnflag").where(F.col("l_returnflag") == "R")
    return load(spark, sf, "orders", "o_orderkey").join(r, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


_SPEECH = """select s.id, case when lower(speaker.name) like 'the %' or lower(speaker.role) in ('president', 'chair', 'acting president', 'secretary-general') then 'procedural'
  when position_in_document > (select min(x.position_in_document) from speeches x where x.document_id = s.document_id and x.speech_type = 'explanation_of_vote') then 'explanation_of_vote' else 'substantive' end as tag from speeches s"""


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    s = load(spark, sf, "speeches").select("id", "document_id", "position_in_document", "speech_type", "speaker.name", "speaker.role")
    first = s.where(F.col("speech_type") == "explanation_of_vote").groupBy("document_id").agg(F.min("position_in_document").alias("first"))
    presides = F.coalesce(F.lower("name").like("the %"), F.lit(False)) | F.coalesce(F.lower("role").isin("president", "chair", "acting president", "secretary-general"), F.lit(False))
    return s.join(first, "document_id", "left").select("id", F.when(presides, "procedural").when(F.col("position_in_document") > F.col("first"), "explanation_of_vote").otherwise("substantive").alias("tag"))


@query("speech_types", _SPEECH)
def speech_types(spark: SparkSession, sf: str) -> DataFrame:
    """Procedural, explanation of vote, or substantive."""
    return tagged(spark, sf)


@query("speech_type_counts", f"select tag, count(*) as n from ({_SPEECH}) group by 1")
def speech_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    """G21."""
    return tagged(spark, sf).groupBy("tag").agg(F.count("*").alias("n"))


_ID = "speaker.name as name, nullif(speaker.country, '-') as country, speaker.organization as organization"


@query(
    "null_safe_speaker",
    f"""with s as (select id, {_ID} from speeches), k as (select name, country, organization, min(id) as speaker_id from s group by all)
  select s.id, k.speaker_id from s join k on s.name is not distinct from k.name and s.country is not distinct from k.country and s.organization is not distinct from k.organization""",
)
def null_safe_speaker(spark: SparkSession, sf: str) -> DataFrame:
    """The identity of a speaker, where null equals null; the key is the lowest row."""
    # nulls get a sign of their own, so that the identity is one key that may be hot (an office holds many rows)
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    s = load(spark, sf, "speeches").select("id", F.array(part(F.col("speaker.name")), part(F.nullif("speaker.country", F.lit("-"))), part(F.col("speaker.organization"))).alias("who"))
    s = s.select("id", F.to_json("who").alias("who"))
    return join_hot(s, s.groupBy("who").agg(F.min("id").alias("speaker_id")), "who", "inner").select("id", "speaker_id")


@query(
    "left_join_on_predicate",
    """select c_custkey, cast(coalesce(min(year(o_orderdate)), case when c_mktsegment = 'MACHINERY' then 1945 when c_mktsegment = 'FURNITURE' then 1946 end) as int) as yr, count(o_orderkey) as n
  from customer left join orders on o_custkey = c_custkey and o_orderstatus = 'F' group by c_custkey, c_mktsegment""",
)
def left_join_on_predicate(spark: SparkSession, sf: str) -> DataFrame:
    """J5 GR6 P27 G10: a predicate inside the outer join, and a year by the first source that has one."""
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").where(F.col("o_orderstatus") == "F")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.year("o_orderdate")).alias("y"), F.count("*").alias("m"))
    c = load(spark, sf, "customer", "c_custkey", "c_mktsegment").join(per, "c_custkey", "left")
    return c.select("c_custkey", F.coalesce("y", F.when(F.col("c_mktsegment") == "MACHINERY", 1945).when(F.col("c_mktsegment") == "FURNITURE", 1946)).alias("yr"), F.coalesce("m", F.lit(0)).alias("n"))


@query(
    "fallback_tally",
    """with t as (select l_partkey, l_suppkey, min(l_orderkey) as o from lineitem group by all), a as (select l_partkey as k, min(o) as v from t where l_suppkey % 3 = 0 group by 1), b as (select l_partkey as k, min(o) as v from t where l_suppkey % 3 = 1 group by 1), c as (select l_partkey as k, max(o) as v from t group by 1)
  select p_partkey, coalesce(a.v, b.v, c.v) as tally, case when a.v is not null then 'first' when b.v is not null then 'second' when c.v is not null then 'third' else 'none' end as tier from part left join a on a.k = p_partkey left join b on b.k = p_partkey left join c on c.k = p_partkey""",
)
def fallback_tally(spark: SparkSession, sf: str) -> DataFrame:
    """Three sources of a value, by rank; all are conditional aggregates of one pass."""
    l = load(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_orderkey").groupBy("l_partkey", "l_suppkey").agg(F.min("l_orderkey").alias("o"))
    t = l.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min(F.when(F.col("l_suppkey") % 3 == 0, F.col("o"))).alias("a"), F.min(F.when(F.col("l_suppkey") % 3 == 1, F.col("o"))).alias("b"), F.max("o").alias("c"))
    out = load(spark, sf, "part", "p_partkey").join(t, "p_partkey", "left")
    tier = F.when(F.col("a").isNotNull(), "first").when(F.col("b").isNotNull(), "second").when(F.col("c").isNotNull(), "third").otherwise("none")
    return out.select("p_partkey", F.coalesce("a", "b", "c").alias("tally"), tier.alias("tier"))


@query("single_resolution_items", "select l_orderkey, min(l_partkey) as l_partkey from lineitem group by 1 having count(*) = 1")
def single_resolution_items(spark: SparkSession, sf: str) -> DataFrame:
    """The only one of its item."""
    l = load(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    return l.groupBy("l_orderkey").agg(F.min("l_partkey").alias("l_partkey"), F.count("*").alias("n")).where("n = 1").drop("n")


@query(
    "unpivot_flags",
    """with f as (select user_id, max((event_type = 'click')::int) as click, max((event_type = 'purchase')::int) as purchase, max((event_type = 'error')::int) as error, max((event_type = 'signup')::int) as signup, max((event_type = 'view')::int) as view from events group by 1)
  select user_id, flag from (unpivot f on click, purchase, error, signup, view into name flag value v) where v = 1""",
)
def unpivot_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Flag columns to rows."""
    kinds = ["click", "purchase", "error", "signup", "view"]
    f = load(spark, sf, "events", "user_id", "event_type").groupBy("user_id").agg(*(F.max((F.col("event_type") == k).cast("int")).alias(k) for k in kinds))
    return f.unpivot("user_id", kinds, "flag", "v").where("v = 1").select("user_id", "flag")


@query("citation_edges", "select citing_id as src, cited_id as dst, cast(sum(weight) as bigint) as weight from resolution_citations where citing_id != cited_id group by all")
def citation_edges(spark: SparkSession, sf: str) -> DataFrame:
    """G12 GR7: repeated edges summed, loops dropped."""
    c = load(spark, sf, "resolution_citations", "citing_id", "cited_id", "weight").where(F.col("citing_id") != F.col("cited_id"))
    return c.groupBy(F.col("citing_id").alias("src"), F.col("cited_id").alias("dst")).agg(F.sum("weight").alias("weight"))


_EDGES = f"{SPONSORS_SQL}, edges as (select a.yr, a.country_id as a, b.country_id as b, count(*) as weight from sponsors a join sponsors b on a.resolution_id = b.resolution_id and a.yr = b.yr and a.country_id < b.country_id group by all)"


def cosponsors(spark: SparkSession, sf: str) -> DataFrame:
    return edge_weights(pairs_in_group(sponsors(spark, sf), ["resolution_id", "yr"], "country_id"), ["yr"])


@query("cosponsor_edges", f"with {_EDGES} select yr, a, b, weight from edges")
def cosponsor_edges(spark: SparkSession, sf: str) -> DataFrame:
    """J27 G13 GR2: how often two states sponsor together."""
    return cosponsors(spark, sf)


@query("degree", f"with {_EDGES} select yr, node, count(*) as n_edges from (select yr, a as node from edges union all select yr, b from edges) group by all")
def degree(spark: SparkSession, sf: str) -> DataFrame:
    """GR5."""
    return cosponsors(spark, sf).select("yr", F.explode(F.array("a", "b")).alias("node")).groupBy("yr", "node").agg(F.count("*").alias("n_edges"))


@query(
    "pagerank_fixed",
    f"""with recursive {_EDGES}, twice as (select yr, a as u, b as v, weight from edges union all select yr, b, a, weight from edges), share as (select yr, u, v, weight / sum(weight) over (partition by yr, u) as p from twice),
  nodes as (select yr, u as node, count(*) over (partition by yr) as n from (select distinct yr, u from twice)),
  r as (select 0 as k, yr, node, n, 1.0e0 / n as rank from nodes union all
    select k + 1, yr, node, n, 0.15e0 / n + 0.85e0 * flow from (select r.k, s.yr, s.v as node, r.n, sum(s.p * r.rank) as flow from r join share s on s.yr = r.yr and s.u = r.node where r.k < 20 group by r.k, s.yr, s.v, r.n))
  select yr, node, round(rank, 9) as rank from r where k = 20""",
)
def pagerank_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """GR3 as joins, twenty rounds."""
    return pagerank_rounds(cosponsors(spark, sf), ["yr"]).withColumn("rank", F.round("rank", 9))


@query("country_network")
def country_network(spark: SparkSession, sf: str) -> DataFrame:
    """GR3 GR4 GR5: PageRank to its tolerance, betweenness and degree of each year's network."""
    return network_stats(cosponsors(spark, sf))


@query("confusion_matrix", "select ocr_quality_label as actual, case when ocr_quality_score >= 0.7 then 'good' when ocr_quality_score >= 0.4 then 'poor' else 'unusable' end as predicted, count(*) as n from documents where ocr_quality_score is not null group by all")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """G25."""
    d = load(spark, sf, "documents", "ocr_quality_label", "ocr_quality_score").where(F.col("ocr_quality_score").isNotNull())
    return d.groupBy(F.col("ocr_quality_label").alias("actual"), F.when(F.col("ocr_quality_score") >= 0.7, "good").when(F.col("ocr_quality_score") >= 0.4, "poor").otherwise("unusable").alias("predicted")).agg(F.count("*").alias("n"))


@query("key_sets", "select key, case when bool_and(s = 'a') then 'only_countries' when bool_and(s = 'b') then 'only_states' else 'both' end as side from (select iso3 as key, 'a' as s from countries where iso3 is not null union select iso_code, 'b' from member_states) group by key")
def key_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Union, intersection and difference of two sets of keys."""
    a = load(spark, sf, "countries", "iso3").where("iso3 is not null").select(F.col("iso3").alias("key")).distinct()
    b = load(spark, sf, "member_states", "iso_code").select(F.col("iso_code").alias("key"))
    part = lambda df, side: df.withColumn("side", F.lit(side))
    return part(a.exceptAll(b), "only_countries").unionByName(part(b.exceptAll(a), "only_states")).unionByName(part(a.intersect(b), "both"))


def filtered_documents(d: DataFrame, body: str | None = None, before: int | None = None) -> DataFrame:
    """Of one body, if one is given, and from before a year, if one is given; records without date stay."""
    if body is not None:
        d = d.where(F.col("body") == body)
    return d if before is None else d.where(F.col("date").isNull() | (F.year("date") < before))


@query("optional_filters", "select 'all' as filter, count(*) as n from documents union all select 'GA', count(*) from documents where body = 'GA' union all select 'GA before 1990', count(*) from documents where body = 'GA' and (date is null or year(date) < 1990)")
def optional_filters(spark: SparkSession, sf: str) -> DataFrame:
    """One plan for filters that are given or not."""
    d = load(spark, sf, "documents", "body", "date")
    cases = {"all": {}, "GA": {"body": "GA"}, "GA before 1990": {"body": "GA", "before": 1990}}
    n = [filtered_documents(d, **c).agg(F.lit(k).alias("filter"), F.count("*").alias("n")) for k, c in cases.items()]
    return reduce(DataFrame.unionByName, n)


@query(
    "debate_probe",
    """select g.id, count(*) as speeches from general_debate_entries g join member_states m on m.state_id = g.country_id
  join (select d.session, n.iso_code from speeches s join documents d on d.doc_id = s.document_id join member_states n on n.member_state = s.speaker.country) k on k.session = g.ga_session and k.iso_code = m.iso_code group by g.id""",
)
def debate_probe(spark: SparkSession, sf: str) -> DataFrame:
    """The speeches that agree with an entry in session and code of the state; counted by key before the join."""
    m = F.broadcast(load(spark, sf, "member_states", "state_id", "iso_code", "member_state"))  # a fixed list
    said = load(spark, sf, "speeches").select("document_id", F.col("speaker.country").alias("member_state")).join(m, "member_state")
    keys = said.join(load(spark, sf, "documents", "doc_id", "session").withColumnRenamed("doc_id", "document_id"), "document_id").groupBy("session", "iso_code").agg(F.count("*").alias("speeches"))
    g = load(spark, sf, "general_debate_entries", "id", "country_id", "ga_session").withColumnsRenamed({"ga_session": "session", "country_id": "state_id"})
    return g.join(m, "state_id").join(keys, ["session", "iso_code"]).select("id", "speeches")
