"""Nested meeting records to the relational tables, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.upsert import first_of


def relational(records: DataFrame) -> dict[str, DataFrame]:
    """documents, items, speakers, speeches, directions, resolutions, votes and country_votes of meeting records (sources.files.meetings).

    Keys are natural or hashes of these, so that runs agree; a record that comes again (same symbol) counts once. Speakers are one for each name, country and organization, where null equals null. Drafts are one for each body, session and symbol. A country's first vote on a resolution counts.
    """
    r = first_of(records.where(F.col("symbol").isNotNull()), ["symbol"], F.col("date").asc_nulls_last())
    key = lambda *c: F.xxhash64(*c)
    documents = r.drop("items", "_corrupt_record").withColumn("id", key("symbol"))
    item = r.select(key("symbol").alias("document_id"), "body", "session", F.explode("items").alias("i"))
    item = item.withColumn("item_id", key("document_id", "i.position"))
    items = item.select(F.col("item_id").alias("id"), "document_id", "i.position", "i.item_type", "i.title", "i.agenda_number", "i.sub_item", "i.continued")
    spoken = item.select("document_id", "item_id", F.explode("i.speeches").alias("s")).select("document_id", "item_id", "s.*")
    who = F.xxhash64(F.coalesce("speaker.name", F.lit("\0")), F.coalesce("speaker.country", F.lit("\0")), F.coalesce("speaker.organization", F.lit("\0")))
    speeches = spoken.select(key("item_id", "position_in_item").alias("id"), "document_id", "item_id", who.alias("speaker_id"), "speaker.language", "speaker.on_behalf_of", "text", F.col("position").alias("position_in_document"), "position_in_item")
    speakers = first_of(spoken.select(who.alias("id"), "speaker.name", "speaker.country", "speaker.organization", "speaker.role", "speaker.title"), ["id"], F.col("role").asc_nulls_last())
    directions = item.select("document_id", "item_id", F.explode("i.stage_directions").alias("d")).select("document_id", "item_id", "d.*")
    res = item.select("document_id", "item_id", "body", "session", F.explode("i.resolutions").alias("x")).select("document_id", "item_id", "body", "session", "x.*")
    res = res.withColumn("resolution_id", key("body", F.coalesce("session", F.lit(-1)), "draft_symbol"))
    resolutions = first_of(res.select(F.col("resolution_id").alias("id"), "body", "session", "draft_symbol", "adopted_symbol", "title"), ["id"], F.col("adopted_symbol").asc_nulls_last())
    votes = first_of(res.select(key("document_id", "resolution_id").alias("id"), "document_id", "item_id", "resolution_id", "vote_type", "yes_count", "no_count", "abstain_count", "position_in_item", "country_votes"), ["id"], F.col("position_in_item"))
    cast = votes.select(F.col("id").alias("vote_id"), F.posexplode("country_votes").alias("n", "c"))
    country_votes = cast.withColumn("r", F.row_number().over(W.partitionBy("vote_id", "c.country").orderBy("n"))).where("r = 1").select("vote_id", "c.country", "c.vote_position")
    return {"documents": documents, "items": items, "speakers": speakers, "speeches": speeches, "directions": directions, "resolutions": resolutions, "votes": votes.drop("country_votes"), "country_votes": country_votes}


def write_records(records: DataFrame, folder: str) -> None:
    """K1: one folder of JSON for each symbol (its slashes are underscores)."""
    records.withColumn("key", F.translate("symbol", "/", "_")).write.mode("overwrite").partitionBy("key").json(folder)


def write_failures(records: DataFrame, folder: str) -> None:
    """K2: what couldn't be read, with the time."""
    records.where(F.col("_corrupt_record").isNotNull()).select(F.col("_corrupt_record").alias("record"), F.current_timestamp().alias("at")).write.mode("append").json(folder)


def write_report(df: DataFrame, folder: str) -> None:
    """A text table with a heading."""
    df.write.mode("overwrite").option("header", "true").csv(folder)
