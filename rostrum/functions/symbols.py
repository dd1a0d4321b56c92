"""Symbols of documents and resolutions in one way of writing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_symbol(c: Column) -> Column:
    """Upper case without spaces, without punctuation at the ends and without a leading word `resolution`; a bare `n/m` is an assembly resolution, a bare `n` or `n(year)` one of the council, whose year is left out. Null and blank give null."""
    s = F.regexp_replace(F.upper(c), r"\s+", "")
    s = F.regexp_replace(s, r"^[.,;:]+|[.,;:]+$", "")
    s = F.regexp_replace(s, r"^RESOLUTION", "")
    s = F.when(s.rlike(r"^\d+/\d+$"), F.concat(F.lit("A/RES/"), s)).when(s.rlike(r"^\d+(\(\d+\))?$"), F.concat(F.lit("S/RES/"), s)).otherwise(s)
    s = F.regexp_replace(s, r"^(S/RES/\d+)\(\d+\)$", "$1")
    return F.when(s != "", s)


#: The same for a SQL engine with RE2; {c} is the column.
CANONICAL_SQL = r"""nullif(regexp_replace(
  case when regexp_full_match({b}, '\d+/\d+') then 'A/RES/' || {b} when regexp_full_match({b}, '\d+(\(\d+\))?') then 'S/RES/' || {b} else {b} end,
  '^(S/RES/\d+)\(\d+\)$', '\1'), '')"""


def canonical_sql(c: str) -> str:
    bare = rf"regexp_replace(regexp_replace(regexp_replace(upper({c}), '\s+', '', 'g'), '^[.,;:]+|[.,;:]+$', '', 'g'), '^RESOLUTION', '')"
    return CANONICAL_SQL.format(b=bare)
