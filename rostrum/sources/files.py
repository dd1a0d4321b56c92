"""Readers of the file layouts that records come in. All columns of text tables are read as strings, and parsed by the text functions."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t

_ELEMENT = "position:int,position_in_item:int"
#: The nested record of a meeting.
MEETING = (
    "symbol string, body string, session int, meeting_number int, date date, location string, president struct<name:string,country:string>, ocr_quality_score double, ocr_quality_label string, ods_used boolean, "
    "items array<struct<position:int,item_type:string,title:string,agenda_number:int,sub_item:string,continued:boolean,"
    f"speeches:array<struct<{_ELEMENT},text:string,speaker:struct<name:string,country:string,organization:string,language:string,role:string,title:string,on_behalf_of:string>>>,"
    f"stage_directions:array<struct<{_ELEMENT},text:string,direction_type:string>>,"
    "resolutions:array<struct<draft_symbol:string,adopted_symbol:string,title:string,vote_type:string,yes_count:int,no_count:int,abstain_count:int,position_in_item:int,country_votes:array<struct<country:string,vote_position:string>>>>>>"
)


def files(spark: SparkSession, folder: str, glob: str, excluding: str | None = None) -> DataFrame:
    """Path, length and content of the files below a folder; `excluding` names a folder whose files are left out."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    return df.where(~F.col("path").rlike(f"/{excluding}/[^/]+$")) if excluding else df


def path_keys(path: str = "path") -> list:
    """Session and symbol from `.../ga/64/pv/document_121.pdf`."""
    p = F.col(path)
    body, session, number = (t.extracted(p, r"(?i)/(ga|sc)/(?:(\d+)/)?(?:pv/)?document_(\d+)\.\w+$", k) for k in (1, 2, 3))
    symbol = F.when(F.lower(body) == "ga", F.concat(F.lit("A/"), session, F.lit("/PV."), number)).when(F.lower(body) == "sc", F.concat(F.lit("S/PV."), number))
    return [session.cast("int").alias("session"), symbol.alias("symbol")]


def meetings(spark: SparkSession, path: str) -> DataFrame:
    """Meeting records; those that aren't valid bear their text in _corrupt_record."""
    return spark.read.schema(f"{MEETING}, _corrupt_record string").option("multiLine", "true").option("mode", "PERMISSIVE").json(path)


def table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A text table with a heading, all columns strings; a byte order mark is dropped."""
    return spark.read.option("header", "true").option("sep", sep).option("multiLine", "true").option("escape", '"').csv(path)


def sniffed_table(spark: SparkSession, path: str) -> DataFrame:
    """As table, by tab or comma, whichever the heading has more often."""
    heading = spark.read.text(path).first()
    line = heading[0] if heading else ""
    return table(spark, path, "\t" if line.count("\t") > line.count(",") else ",")


def first_column(df: DataFrame, *names: str):
    """The first filled one of the columns that an edition has."""
    have = [t.blank_to_null(F.col(f"`{n}`")) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def members(archives: DataFrame, suffix: str = "") -> DataFrame:
    """Path and content of the members of tar, tar.gz and zip archives(content); an archive is read in one task, member by member."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for raw in b["content"]:
                data = io.BytesIO(raw)
                if zipfile.is_zipfile(data):
                    with zipfile.ZipFile(data) as z:
                        for n in z.namelist():
                            if n.endswith(suffix) and not n.endswith("/"):
                                yield pd.DataFrame({"path": [n], "content": [z.read(n)]})
                else:
                    data.seek(0)
                    with tarfile.open(fileobj=data, mode="r|*") as z:
                        for m in z:
                            if m.isfile() and m.name.endswith(suffix):
                                yield pd.DataFrame({"path": [m.name], "content": [z.extractfile(m).read()]})

    return archives.select("content").mapInPandas(run, "path string, content binary")


def corpus_key(path: str = "path") -> list:
    """`FRA_12_1957.txt`."""
    p = r"([A-Z]{3})_(\d+)_(\d{4})\.txt$"
    return [t.extracted(F.col(path), p, 1).alias("iso3"), t.extracted(F.col(path), p, 2).cast("int").alias("session"), t.extracted(F.col(path), p, 3).cast("int").alias("year")]


def resolution_key(path: str = "path"):
    """`S_RES_0242_1967_EN.txt` is S/RES/242(1967)."""
    p = r"S_RES_0*(\d+)_(\d{4})"
    return F.when(t.extracted(F.col(path), p, 1).isNotNull(), F.concat(F.lit("S/RES/"), t.extracted(F.col(path), p, 1), F.lit("("), t.extracted(F.col(path), p, 2), F.lit(")"))).alias("symbol")


def graph_edges(spark: SparkSession, path: str) -> DataFrame:
    """Src, dst, weight of a GraphML file; loops dropped, repeated edges summed."""
    e = spark.read.format("xml").option("rowTag", "edge").schema("_source string, _target string, data array<struct<_key:string,_VALUE:string>>").load(path)
    weight = F.coalesce(F.try_element_at(F.filter("data", lambda d: d["_key"].rlike("(?i)weight")), F.lit(1))["_VALUE"].cast("double"), F.lit(1.0))
    return e.where(F.col("_source") != F.col("_target")).groupBy(F.col("_source").alias("src"), F.col("_target").alias("dst")).agg(F.sum(weight).alias("weight"))


def drafts(spark: SparkSession, folder: str) -> DataFrame:
    """Drafts of a folder of JSON files that have an id and a content, with their list of authors."""
    d = spark.read.schema("ID string, Title string, Authors string, Content string, Date string").option("multiLine", "true").option("recursiveFileLookup", "true").json(folder)
    return d.where(t.blank_to_null(F.col("ID")).isNotNull() & t.blank_to_null(F.col("Content")).isNotNull()).withColumn("authors", t.string_list(F.col("Authors")))


def triples(spark: SparkSession, path: str) -> DataFrame:
    """Subject, predicate, object of a thesaurus in Turtle that lists one predicate a line: subjects begin a line, the rest is indented; statements end with `;` or `.`, several objects stand between commas."""
    raw = spark.read.text(path, wholetext=True)
    statements = raw.select(F.explode(F.split("value", r"(?m)\s*\.\s*$")).alias("s")).where(~F.trim("s").startswith("@") & (F.trim("s") != ""))
    parts = statements.select(F.regexp_extract("s", r"(?s)^\s*(\S+)", 1).alias("subject"), F.explode(F.split(F.regexp_replace("s", r"(?s)^\s*\S+\s+", ""), r";\s*")).alias("po"))
    pairs = parts.where(F.trim("po") != "").select("subject", F.regexp_extract(F.trim("po"), r"^(\S+)", 1).alias("predicate"), F.explode(F.split(F.regexp_replace(F.trim("po"), r"^\S+\s+", ""), r"\s*,\s+(?=[<\"\w])")).alias("object"))
    return pairs.withColumn("object", F.trim("object"))
