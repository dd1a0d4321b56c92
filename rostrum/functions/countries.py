"""Names of states in one spelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tidy_country(c: Column) -> Column:
    """Without page references and what stands before the first letter, words torn at a hyphen joined, white space squeezed, notes on the language and remarks behind a dash left out; names in one case only get capitals at the start of each run of letters. Blank gives an empty string."""
    s = F.regexp_replace(c, r"\x08\d*|[\x00-\x08]", "")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    s = F.regexp_replace(s, r"^[^\p{L}]+", "")
    s = F.regexp_replace(s, r"(?i)\s*\(spoke in [^)]*\)|\s*--.*$", "")
    s = F.regexp_replace(s, r"[\s.,;:'\"]+$", "")
    one_case = s.rlike(r"\p{L}") & ((s == F.upper(s)) | (s == F.lower(s))) & (F.length(s) > 3)
    runs = F.regexp_extract_all(F.lower(s), F.lit(r"([a-z]+|[^a-z]+)"), F.lit(1))
    titled = F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1_000_000))), "")
    s = F.when(one_case, titled).otherwise(s)
    return F.regexp_replace(s, r"(\p{L})- (\p{Ll})", "$1$2")


def canonical_countries(values: DataFrame, aliases: DataFrame, column: str = "value") -> DataFrame:
    """values with `canonical`: the entry that the tidied value is an alias of, whatever its case, or else the tidied value itself. aliases(alias, canonical) has one canonical name for each alias; of several the first in order."""
    known = aliases.groupBy(F.lower("alias").alias("_k")).agg(F.min("canonical").alias("_c"))
    tidied = values.withColumn("_t", tidy_country(F.col(column))).withColumn("_k", F.lower("_t"))
    return tidied.join(known, "_k", "left").withColumn("canonical", F.coalesce("_c", "_t")).drop("_k", "_t", "_c")
