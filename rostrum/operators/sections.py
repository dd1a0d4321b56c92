"""Segmentation of a meeting's text: paragraphs to typed sections, sections to items with speeches, directions, resolutions and ballots; all by windows over a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t

# Forms of print noise, of labels, of agenda headings.
NOISE = r"(?i)^\s*(?:|\d{1,4}|page \d+|\d{2}-\d{5}(?:\s*\([a-z]\))?|\d{2}-\d{5}\s+\d+/\d+|\*\d+\*|this record contains .*|corrections .* should be (?:submitted|sent).*|(?:general assembly|security council)\s+[as]/\S+|[as]/(?:\d+/)?pv\.\d+)\s*$"
SPEAKER_BOLD = r"^\s*(?:\d+\.\s*)?(?:(?:Mr|Mrs|Ms|Miss|Dr|Sir|Dame)\.?\s|The (?:Acting |Vice-)?(?:President|Chair|Secretary-General)\b)"
SPEAKER_CAPS = r"^\s*(?:\d+\.\s*)?(?:(?:MR|MRS|MS|MISS|DR|SIR|DAME)\.?\s+[A-Z'’.\- ]{2,60}(?:\([^)]{2,60}\))?|THE (?:ACTING )?(?:PRESIDENT|CHAIRMAN))\s*(?:\([^)]*\))?\s*[:;]"
AGENDA = r"(?i)^\s*agenda items?\s+\d+"
DRAFT = r"(?i)^\s*draft (?:resolution|decision)\s*\(?[as]?/?"


def first_shown(segments: str, style: str) -> Column:
    """A2: whether the first segment that isn't blank bears the style."""
    return F.expr(f"coalesce(try_element_at(filter({segments}, s -> trim(s.text) != ''), 1).{style}, false)")


def all_shown(segments: str, style: str) -> Column:
    """A3: whether there are segments that aren't blank and all bear the style."""
    return F.expr(f"size(filter({segments}, s -> trim(s.text) != '')) > 0 and forall(filter({segments}, s -> trim(s.text) != ''), s -> s.{style})")


def block_text(segments: str) -> Column:
    """A1: the segments' texts in a row."""
    return F.expr(f"array_join(transform({segments}, s -> s.text), '')")


def reading_order(blocks: DataFrame, doc: str = "doc", page: str = "page_num", share: float = 0.2) -> DataFrame:
    """blocks(doc, page_num, x0, y0, page_width) with `seq`, their place in the document: one column if fewer than a fifth of a page's blocks begin right of its middle, else the left column before the right one."""
    right = F.col("x0") >= F.col("page_width") / 2
    two = F.avg(right.cast("double")).over(W.partitionBy(doc, page)) >= share
    column = F.when(two & right, 1).otherwise(0)
    return blocks.withColumn("_c", column).withColumn("seq", F.row_number().over(W.partitionBy(doc).orderBy(page, "_c", "y0", "x0")) - 1).drop("_c")


def clean_blocks(blocks: DataFrame, text: str = "text") -> DataFrame:
    """Without print noise and without what stands in the top 9 or the bottom 5 per cent of a page (842 points high where unknown)."""
    high = F.when(F.col("page_height") > 0, F.col("page_height")).otherwise(842.0)
    return blocks.where(~F.col(text).rlike(NOISE) & (F.col("y0") >= 0.09 * high) & (F.col("y0") <= 0.95 * high))


def best_source(candidates: DataFrame, doc: str = "doc") -> DataFrame:
    """Of several texts of one document that with the best score; on a tie the one with the highest priority. candidates(doc, score, priority, ...)."""
    return candidates.withColumn("_r", F.row_number().over(W.partitionBy(doc).orderBy(F.col("score").desc_nulls_last(), F.col("priority").desc()))).where("_r = 1").drop("_r")


def kind(text: str = "text", bold: str = "bold_start", italic: str = "all_italic") -> Column:
    """Stage, agenda, draft, speaker or continuation, in this order of priority."""
    c = F.col(text)
    speaker = F.when(F.col(bold), c.rlike(SPEAKER_BOLD)).otherwise(c.rlike(SPEAKER_CAPS))
    return F.when(F.col(italic) | (c.rlike(r"(?i)\bwas adopted\b") & (F.length(c) < 200)), "stage").when(c.rlike(AGENDA), "agenda").when(c.rlike(DRAFT), "draft").when(speaker, "speaker").otherwise("continuation")


def sectionise(blocks: DataFrame, doc: str = "doc", seq: str = "seq") -> DataFrame:
    """Doc, section_id, kind, text, lines (the text with its blocks as lines), position. Blocks before the first that isn't a continuation are the cover. Stage directions stand alone; others take in the continuations after them. blocks(doc, seq, text, bold_start, all_italic); a null document belongs to none."""
    w = W.partitionBy(doc).orderBy(seq)
    k = blocks.where(F.col(doc).isNotNull()).withColumn("kind", kind()).withColumn("_last", F.lag("kind").over(w))
    starts = F.col("kind").isin("agenda", "draft", "speaker", "stage") | (F.col("_last") == "stage") | F.col("_last").isNull()
    k = k.withColumn("section_id", F.sum(starts.cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)) - 1)
    k = k.withColumn("_seen", F.max((F.col("kind") != "continuation").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    parts = F.sort_array(F.collect_list(F.struct(seq, "text")))
    out = k.groupBy(doc, "section_id").agg(F.min_by("kind", seq).alias("kind"), F.max("_seen").alias("_seen"), F.filter(F.transform(parts, lambda p: F.trim(p["text"])), lambda x: x != "").alias("_lines"), F.min(seq).alias("position"))
    out = out.select(doc, "section_id", "kind", "_seen", F.array_join("_lines", " ").alias("text"), F.array_join("_lines", "\n").alias("lines"), "position")
    return out.withColumn("kind", F.when(F.col("_seen") == 0, "cover").when(F.col("kind") == "continuation", "text").otherwise(F.col("kind"))).drop("_seen")


#: How many sections after an adoption may hold its lists and totals.
FOLLOWING = 80
#: How many speeches back a draft may have been named that is adopted without its symbol.
SPEECHES = 5


def items(sections: DataFrame, doc: str = "doc") -> DataFrame:
    """The elements of each document in order: item headings, speeches, directions and resolutions: doc, item, element, position_in_item, position_in_document, title, speaker, text, draft_symbol, adopted_symbol, vote_type, yes, no, abstain, votes.

    Speeches, directions and resolutions count up within their item; speeches and directions within the document. Text without a label goes on with the last speech of its item, or opens one. A line that says that a draft was adopted makes a resolution, wherever it stands; the draft is the one that it names, or that of the last draft heading of the item, or (in a speech) the first that one of the last SPEECHES speeches names. The same draft is a resolution once for each item. Its lists of states stand between `A recorded vote was taken` and the adoption, or in the section before it, or after it up to the next speaker or vote; a vote is recorded if it was announced as such or counted. sections(doc, section_id, kind, text, lines) are those of sectionise; a document's cover has no elements.
    """
    c, kind = F.col("text"), F.col("kind")
    rows = sections.where(kind != "cover").select(doc, "section_id", "kind", "text", "lines", t.split_attribution(c).alias("split"))
    w = W.partitionBy(doc).orderBy("section_id")
    past, own = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(W.unboundedPreceding, 0)
    count = lambda x, over: F.coalesce(F.sum(F.when(x, 1)).over(over), F.lit(0)).cast("int")
    agenda, speaker, stage, draft = (kind == k for k in ("agenda", "speaker", "stage", "draft"))
    adopts = t.is_adoption(c) & (agenda | speaker | stage | draft)
    signal = stage & c.rlike(r"(?i)vote\s+was\s+taken")
    # a vote is open from its announcement to the adoption or the next speaker
    opened = F.last(F.when(signal, F.col("section_id")).when(agenda | speaker | (stage & adopts), -1), ignorenulls=True).over(past)
    ballot = (F.coalesce(opened, F.lit(-1)) >= 0) & ((kind == "text") | (stage & c.rlike(rf"(?i)^\s*{t.LIST_HEADING}")))
    rows = rows.select("*", count(agenda, own).alias("item"), count(agenda | speaker, own).alias("turn"), adopts.alias("adopts"), signal.alias("signal"), F.coalesce(opened, F.lit(-1)).alias("opened"), ballot.alias("ballot"), F.lag("lines").over(w).alias("before"))

    wi = W.partitionBy(doc, "item").orderBy("section_id").rowsBetween(W.unboundedPreceding, 0)
    words = (kind == "text") & ~F.col("ballot")
    spoken = speaker | (words & (count(speaker | words, wi) == 1))
    rows = rows.withColumn("spoken", spoken)
    symbol = lambda x: t.repair_draft_symbol(t.extracted(x, r"(?i)([AS]/(?:[^)\s,]|,(?=\d))+)"))
    rows = rows.withColumn("speech", count(F.col("spoken"), wi)).withColumn("header", F.last(F.when(draft, symbol(c)), ignorenulls=True).over(wi)).withColumn("titled", F.first(F.when(agenda, c), ignorenulls=True).over(wi))
    lately = W.partitionBy(doc, "item").orderBy("speech").rangeBetween(1 - SPEECHES, 0)  # only a speech's own row has a symbol, so ties don't matter
    rows = rows.withColumn("named", F.first(F.when(F.col("spoken"), symbol(c)), ignorenulls=True).over(lately))
    whole = F.collect_list(F.when(F.col("spoken") | words, F.struct("section_id", F.when(speaker, F.col("split.body")).otherwise(c).alias("x")))).over(W.partitionBy(doc, "item", "speech"))
    rows = rows.withColumn("said", F.array_join(F.filter(F.transform(F.sort_array(whole), lambda x: F.trim(x["x"])), lambda x: x != ""), " "))

    null = lambda kind_of="string": F.lit(None).cast(kind_of)
    element = lambda name, rank, **x: F.struct(F.lit(name).alias("element"), F.lit(rank).alias("rank"), x.get("speaker", null()).alias("speaker"), x.get("text", null()).alias("text"), x.get("draft", null()).alias("draft"))
    drafted = F.coalesce(t.adoption(c)["draft"], "header", F.when(speaker, F.col("named")))
    kinds = F.array_compact(F.array(
        F.when(agenda, element("item", 0)),
        F.when(F.col("spoken"), element("speech", 1, speaker=F.when(speaker, F.col("split.attribution")), text=F.col("said"))),
        F.when(stage, element("direction", 1, text=c)),
        F.when(F.col("adopts") & drafted.isNotNull(), element("resolution", 2, draft=drafted, text=F.col("lines"))),
    ))
    each = rows.withColumn("e", F.explode(kinds)).select(doc, "item", "section_id", "turn", "kind", "opened", "before", "titled", "e.*")
    first = F.row_number().over(W.partitionBy(doc, "item", "element", "draft").orderBy("section_id"))
    each = each.withColumn("_n", F.when(F.col("element") == "resolution", first).otherwise(1)).where("_n = 1").drop("_n")
    wi, wd = (W.partitionBy(*p).orderBy("section_id", "rank").rowsBetween(W.unboundedPreceding, 0) for p in ((doc, "item"), (doc,)))
    is_, counted = F.col("element"), F.col("element").isin("speech", "direction")
    each = each.withColumn("position_in_item", F.when(is_ != "item", count(is_ != "item", wi) - 1)).withColumn("position_in_document", F.when(counted, count(counted, wd) - 1))
    return _with_votes(each, rows, doc)


def _with_votes(each: DataFrame, rows: DataFrame, doc: str) -> DataFrame:
    """The elements with what was voted on each resolution; only the turns in which something was adopted, and those before them, are looked at."""
    turns = rows.groupBy(doc, "turn").agg(F.sort_array(F.collect_list(F.struct("section_id", "lines", "opened", "ballot", (F.col("signal") | F.col("adopts")).alias("other")))).alias("parts"))
    made = each.where("element = 'resolution'").select(doc, "item", "draft", "section_id", "turn", "kind", "opened", "before", "text")
    parts = made.join(turns, [doc, "turn"]).join(turns.select(doc, (F.col("turn") + 1).alias("turn"), F.col("parts").alias("earlier")), [doc, "turn"], "left")
    # the announcement in a speech comes after lists that stand in the turn before it
    lists = F.when(F.col("kind") == "speaker", F.filter(F.coalesce("earlier", F.array().cast(parts.schema["parts"].dataType)), lambda p: p["ballot"])).otherwise(F.filter("parts", lambda p: p["ballot"] & (p["section_id"] < F.col("section_id")) & (p["opened"] == F.col("opened"))))
    next_ = F.array_min(F.transform(F.filter("parts", lambda p: p["other"] & (p["section_id"] > F.col("section_id"))), lambda p: p["section_id"]))
    after = F.slice(F.filter("parts", lambda p: (p["section_id"] > F.col("section_id")) & (next_.isNull() | (p["section_id"] < next_))), 1, FOLLOWING)
    lines = lambda x: F.array_join(F.transform(x, lambda p: p["lines"]), "\n")
    announced = (F.size("lists") > 0) | (F.col("opened") >= 0)
    inside = F.coalesce(F.col("before").rlike(rf"(?i){t.LIST_HEADING}"), F.lit(False)) & (F.col("kind") == "stage")
    context = F.when(F.size("lists") > 0, lines(F.col("lists"))).when(inside, F.col("before")).otherwise(lines(F.col("after")))
    parts = parts.withColumn("lists", lists).withColumn("after", after).withColumn("context", context).withColumn("announced", announced | (inside & F.col("before").rlike(r"(?i)vote\s+was\s+taken")))
    places = F.array(F.col("text"), lines(F.slice("after", 1, SPEECHES)), F.when(F.col("announced"), F.col("context")))
    totals = F.get(F.filter(F.transform(places, t.vote_totals), lambda x: x["yes"].isNotNull()), F.lit(0))
    voted = parts.withColumn("totals", totals)
    recorded = F.col("announced") | F.col("totals.yes").isNotNull()
    none = F.array().cast("array<struct<country:string,position:string>>")
    voted = voted.select(doc, "item", "draft", t.adoption(F.col("text"))["adopted"].alias("adopted_symbol"), F.when(recorded, "recorded").otherwise("consensus").alias("vote_type"), "totals.yes", "totals.no", "totals.abstain", F.when(recorded, t.let(F.concat_ws("\n", "text", "context"), t.country_votes)).otherwise(none).alias("votes"))
    out = each.join(voted, [doc, "item", "draft"], "left")
    return out.select(doc, "item", "element", "position_in_item", "position_in_document", F.col("titled").alias("title"), "speaker", F.when(F.col("element") != "resolution", F.col("text")).alias("text"), F.col("draft").alias("draft_symbol"), "adopted_symbol", "vote_type", "yes", "no", "abstain", "votes")
