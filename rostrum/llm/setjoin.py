"""Set-similarity join with prefix, length and positional filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_rarity(sets: DataFrame, counts: DataFrame, key: str, tokens: str) -> DataFrame:
    """key and its distinct tokens, the globally rarest first (ties by the token itself)."""
    each = sets.select(key, F.explode(F.array_distinct(tokens)).alias("token")).join(counts, "token")
    ordered = F.array_sort(F.collect_list(F.struct("n", "token")))
    return each.groupBy(key).agg(F.transform(ordered, lambda x: x["token"]).alias(tokens))


def prefix(tokens: Column, t: float) -> Column:
    """Of two sets with a Jaccard similarity of t or more at least one common token lies in both prefixes."""
    n = F.size(tokens)
    return F.slice(tokens, 1, F.greatest(F.lit(1), n - F.ceil(n * F.lit(t) - F.lit(1e-9)).cast("int") + 1))


def set_join(left: DataFrame, right: DataFrame, t: float, left_key: str = "left", right_key: str = "right", tokens: str = "tokens") -> DataFrame:
    """All pairs (left_key, right_key, jaccard) of sets with a Jaccard similarity of t or more, each once.

    left and right have a key, distinct in each, and an array of tokens; sets that are null or empty match nothing. Tokens are ordered by how many sets of both sides hold them, and only the prefixes meet. A pair is looked at only where the meeting token is its first common one, so that no pair has to be made distinct afterwards.
    """
    l, r = left.where(F.size(tokens) > 0).select(left_key, tokens), right.where(F.size(tokens) > 0).select(right_key, tokens)
    counts = l.select(F.explode(F.array_distinct(tokens)).alias("token")).unionAll(r.select(F.explode(F.array_distinct(tokens)).alias("token"))).groupBy("token").agg(F.count("*").alias("n"))
    in_right = r.select(F.explode(tokens).alias("token")).distinct()
    l, r = by_rarity(l, counts, left_key, tokens), by_rarity(r, counts, right_key, tokens)
    a = l.withColumn("pa", prefix(F.col(tokens), t)).select(left_key, F.col(tokens).alias("ta"), "pa", F.posexplode("pa").alias("i", "token")).join(in_right, "token", "left_semi")
    b = r.withColumn("pb", prefix(F.col(tokens), t)).select(right_key, F.col(tokens).alias("tb"), "pb", F.posexplode("pb").alias("j", "token"))
    na, nb = F.size("ta"), F.size("tb")
    need = F.lit(t / (1 + t)) * (na + nb) - F.lit(1e-9)
    met = a.join(b, "token").where((na >= F.lit(t) * nb - F.lit(1e-9)) & (nb >= F.lit(t) * na - F.lit(1e-9)))  # lengths
    met = met.where(F.least(na - F.col("i"), nb - F.col("j")) >= need)  # positions: what may still be common
    met = met.where(F.element_at(F.array_intersect("pa", "pb"), 1) == F.col("token"))
    common = F.size(F.array_intersect("ta", "tb"))
    return met.select(left_key, right_key, (common / (na + nb - common)).alias("jaccard")).where(F.col("jaccard") >= F.lit(t) - F.lit(1e-9))
