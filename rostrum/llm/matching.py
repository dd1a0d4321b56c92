"""Matching of entities across sources without keys: Gaussian mixtures over similarity vectors, fitted without labels.

Pairs that share a block get a vector of similarities. Two Gaussians, for matched and unmatched pairs, are fitted by expectation-maximisation; similarities are independent within each, a missing one says nothing, and a ridge on the variances keeps them regular. Transitivity holds within each expectation step: targets of one entry would have to be one event, and different targets are different events, so an entry means one of them at most, and the posteriors of its pairs, together with that of no match at all, add up to one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import Registry
from ..runtime import cut, held, join_hot
from ..tables import load
from .lists import MOST_ENTRIES, StateForms, state_entries
from .names import all_names, bearers
from .strings import unaccent, within

query = Registry()

ROUNDS = 12
RIDGE = 0.02
#: The posterior that a match must reach.
LEAST = 0.5


@dataclass
class Mixture:
    """Prior of an entry to have a match; means and variances of the similarities of matched and unmatched pairs."""

    weight: float
    mean: tuple[np.ndarray, np.ndarray]
    var: tuple[np.ndarray, np.ndarray]

    def odds(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Matched over unmatched density of each row, prior included, which the `rows` of the same entry share. A similarity that is missing says nothing."""
        (ma, mb), (va, vb) = self.mean, self.var
        each = (x - mb) ** 2 / (2 * vb) - (x - ma) ** 2 / (2 * va) + 0.5 * np.log(vb / va)
        return np.exp(np.clip(np.nansum(each, axis=1) + math.log(self.weight / (1 - self.weight)) - np.log(rows), -60, 60))


def by_entry(batches: Iterator[pd.DataFrame], entry: str) -> Iterator[pd.DataFrame]:
    """The rows of a partition that is sorted by entry, so that no entry is cut in two."""
    held: pd.DataFrame | None = None
    for b in batches:
        b = b if held is None else pd.concat([held, b], ignore_index=True)
        last = b[entry] == b[entry].iloc[-1] if len(b) else pd.Series(dtype=bool)
        held = b[last]
        if not last.all():
            yield b[~last].reset_index(drop=True)
    if held is not None and len(held):
        yield held.reset_index(drop=True)


def constrained(b: pd.DataFrame, entry: str, mix: Mixture | None, xs: list[str]) -> np.ndarray:
    """The posterior that any target of each row is meant, where of one entry's targets one at most is meant; without a mixture by the first partition, in which the unlikely rows of an entry count as one together.

    A row stands for all targets of an entry with the same similarities. How many they are says nothing against other rows, as densities and prior are those of rows too: the larger the tables, the more targets share a block by chance.
    """
    _, group, n = np.unique(b[entry].to_numpy(), return_inverse=True, return_counts=True)
    if mix is None:
        p = b["start"].to_numpy(dtype=float)
        odds = p / (1 - p) / np.where(p < 0.5, n[group], 1)
    else:
        odds = mix.odds(b[xs].to_numpy(dtype=float), n[group])
    return odds / (1 + np.bincount(group, weights=odds)[group])


def moments(rows: list) -> Mixture | None:
    """The mixture that sums give: the number of entries; then weights, known values, values and squares, for matched and unmatched."""
    sums = np.sum([np.array(r, dtype=float) for r in rows], axis=0) if rows else np.zeros(1)
    entries, parts = sums[0], []
    for part in np.split(sums[1:], 2) if entries else ():
        known, first, second = part[1:].reshape(3, -1)
        if part[0] < 1e-6:
            return None
        mean = np.where(known > 0, first / np.maximum(known, 1e-9), 0.5)
        parts.append((part[0], mean, np.where(known > 0, second / np.maximum(known, 1e-9) - mean**2, 0.25)))
    if not parts:
        return None
    (a, ma, va), (_, mb, vb) = parts
    return Mixture(min(max(a / entries, 1e-4), 1 - 1e-4), (ma, mb), (np.maximum(va, 0) + RIDGE, np.maximum(vb, 0) + RIDGE))


def fit(pairs: DataFrame, entry: str, xs: list[str], rounds: int = ROUNDS) -> Mixture | None:
    """The mixture of pairs(entry, xs..., start), whose partitions hold whole entries, sorted. A vector counts once for each entry that has it, by the posterior that any of its targets is meant: the many targets that only share a block with an entry are no better known than one of them. Each round reads the pairs where they lie; a row of sums for each partition comes to the driver."""

    def step(mix: Mixture | None) -> Mixture | None:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(1 + 2 * (1 + 3 * len(xs)))
            for b in by_entry(batches, entry):
                x = b[xs].to_numpy(dtype=float)
                p = constrained(b, entry, mix, xs)
                known, filled = ~np.isnan(x), np.nan_to_num(x)
                total += np.concatenate([[b[entry].nunique()], *(v for w in (p, 1 - p) for v in ([w.sum()], w @ known, w @ filled, w @ filled**2))])
            yield pd.DataFrame({"sums": [total.tolist()]})

        return moments([r[0] for r in pairs.mapInPandas(run, "sums array<double>").collect()])

    mix = step(None)
    for _ in range(rounds):
        if mix is None:
            return None
        new = step(mix)
        if new is not None and abs(new.weight - mix.weight) < 1e-4 and max(np.abs(new.mean[0] - mix.mean[0])) < 1e-3:
            return new
        mix = new
    return mix


def matches(pairs: DataFrame, entry: str, target: str, xs: list[str], start: Column, least: float = LEAST, prefer: str | None = None) -> DataFrame:
    """entry, target, confidence: for each entry the target with the highest posterior. Targets with equal similarities share their posterior; the one with the lowest `prefer`, then the lowest target, is given, with its own share as confidence, if together they reach `least`.

    Pairs are distinct. Equal similarities of one entry are one row with the number of targets, so that an entry has as many rows as there are different vectors of (rounded) similarities, however many targets share its block.
    """
    kinds = dict(pairs.dtypes)
    first = F.min(F.struct(*([prefer] if prefer else []), target))[target]
    single = pairs.groupBy(entry, *xs).agg(first.alias(target), F.count("*").alias("copies")).withColumn("start", start)
    single = cut(single.repartition(F.col(entry)).sortWithinPartitions(entry))
    mix = fit(single, entry, xs)
    if mix is None:
        return pairs.select(entry, target, F.lit(0.0).alias("confidence")).where("false")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in by_entry(batches, entry):
            b = b.assign(confidence=constrained(b, entry, mix, xs) / b["copies"])
            best = b.sort_values([entry, "confidence", target], ascending=[True, False, True]).drop_duplicates(entry)
            yield best[best["confidence"] * best["copies"] >= least][[entry, target, "confidence"]]

    return single.mapInPandas(run, f"{entry} {kinds[entry]}, {target} {kinds[target]}, confidence double")


# General debate: entries and speeches.

#: The model of addresses: so many of the speeches that surely are addresses train it (those with the lowest hash), a word counts if it stands in this share of them and this many times as often as in all speeches, and of these so many words at most.
SURE, WORD_SHARE, LIFT, MODEL_WORDS = 20_000, 0.02, 3.0, 10_000
#: The logarithm of the odds against an address before any word is read.
AGAINST = 4.0

def address_words(speeches: DataFrame, sure: DataFrame, bound: int = SURE) -> dict[str, float]:
    """The words that tell addresses from other speeches, with the logarithms of how many times as often they stand in one.

    Words are what stands between blanks, in lower case. speeches(target_id, text) are counted whole and all; sure(target_id) are addresses, of which `bound` at most train. Each word counts once for each speech.
    """
    chosen = sure.distinct().withColumn("h", F.xxhash64("target_id")).orderBy("h", "target_id").limit(bound).select("target_id", F.lit(1).alias("sure"))
    words = F.array_distinct(F.split(F.lower("text"), r"\s+"))
    flagged = speeches.where(F.length("text") > 0).join(F.broadcast(chosen), "target_id", "left")  # `bound` rows at most
    counts = cut(flagged.select("sure", F.explode(F.array_append(words, "")).alias("word")).groupBy("word").agg(F.count("sure").alias("s"), F.count("*").alias("n")))
    if (total := counts.where(F.col("word") == "").first()) is None or not total["s"]:
        return {}
    lift = (F.col("s") / total["s"]) / (F.col("n") / total["n"])
    telling = counts.where((F.col("word") != "") & (F.col("s") >= total["s"] * WORD_SHARE) & (lift >= LIFT))
    return {r["word"]: math.log(r["lift"]) for r in telling.withColumn("lift", lift).orderBy(F.desc("s"), "word").limit(MODEL_WORDS).collect()}


def address_likeness(weights: dict[str, float]):
    """A function of whole texts: the probability that a speech with these words is an address, every word being evidence by itself."""

    def likeness(texts: pd.Series) -> pd.Series:
        known = weights.keys()
        sums = [sum(weights[w] for w in known & set(t.lower().split())) if t else 0.0 for t in texts]
        return pd.Series([1 / (1 + math.exp(AGAINST - x)) for x in sums], dtype="float64")

    return F.pandas_udf(likeness, "double")


def name_likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(x: str, y: str) -> float:
        p, q = (sorted(w for w in "".join(c if c.isalnum() else " " for c in unaccent(z or "").lower()).split() if w not in ("mr", "mrs", "ms", "dr", "h", "e", "amb")) for z in (x, y))
        if not p or not q:
            return 0.0
        short, long = (p, q) if len("".join(p)) <= len("".join(q)) else (q, p)
        good = sum(max((1 - (within(w, v, 2) if within(w, v, 2) is not None else 9) / max(len(w), len(v)) if len(w) > 1 else float(v[0] == w)) for v in long) > 0.6 for w in short)
        return good / len(short)

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


def country_likeness(entries: DataFrame):
    """A function (ref_id, typed value) for the entries(value, ref_id) of a list of states: 1 if the value names the entry, nearly at least; 0 if it names another; null if it names none or says nothing."""
    known: dict[str, dict[int, set[str]]] = {}
    names: dict[int, set[tuple[str, str]]] = {}
    rows = entries.limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"the list of states has more than {MOST_ENTRIES} names")
    forms_of = StateForms((r["ref_id"], r["value"]) for r in rows)
    for r in rows:
        for core, marks, kinds in forms_of(r["value"]):
            known.setdefault(core, {}).setdefault(r["ref_id"], set()).add(" ".join(kinds))
            names.setdefault(r["ref_id"], set()).add((core, marks))

    def likeness(ids: pd.Series, typed: pd.Series) -> pd.Series:
        out = []
        for i, t in zip(ids, typed):
            forms = forms_of(t) if t and i == i and i is not None else []
            if not forms:
                out.append(None)
                continue
            core, marks, kinds = forms[0]
            owners = known.get(core, {})
            if int(i) in owners:  # several states may share a core; their kinds tell them apart
                out.append(1.0 if len(owners) == 1 or " ".join(kinds) in owners[int(i)] or not any(" ".join(kinds) in k for k in owners.values()) else 0.0)
            elif owners:
                out.append(0.0)
            else:
                near = any(m == marks and within(core, c, 1 if len(c) < 6 else 2) is not None for c, m in names.get(int(i), ()) if len(c) > 4)
                out.append(1.0 if near else None)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(likeness, "double")


def date_likeness(a: Column, b: Column) -> Column:
    """1 on the same day, less by each day off, some for an exchanged month and day, a wrong year or month; null if one is missing."""
    off = F.abs(F.datediff(a, b))
    swapped = (F.year(a) == F.year(b)) & (F.month(a) == F.day(b)) & (F.day(a) == F.month(b))
    year_off = (F.month(a) == F.month(b)) & (F.day(a) == F.day(b)) & (F.abs(F.year(a) - F.year(b)) <= 1)
    month_off = (F.year(a) == F.year(b)) & (F.day(a) == F.day(b))
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(off == 0, 1.0).when(off <= 3, 1.0 - 0.08 * off).when(swapped | year_off, 0.8).when(off.between(361, 370), 0.7).when(month_off, 0.6).when(off <= 10, 0.5).when(off <= 40, 0.2).otherwise(0.0)


def debate_matches(spark: SparkSession, sf: str) -> DataFrame:
    """entry_id, target_id, confidence of general_debate_entries and the speeches that they list.

    Blocks are the person that both names mean, or their surname where that isn't known, with the session (one off at most) or the day (up to three days off, with day and month exchanged, or a year off), so that a frequent name alone pairs nothing. Whether a speech is an address at all is one of the similarities: its words, those of the whole text, are weighed by how typical they are of the speeches whose name, session and day all agree with an entry. Repeated rows of a speech are one target, the lowest id.
    """
    entries = load(spark, sf, "general_debate_entries", "id", "country_id", "speaker_name", "ga_session", "meeting_date").withColumnRenamed("id", "entry_id")
    documents = load(spark, sf, "documents", "doc_id", "session", "date").withColumnRenamed("doc_id", "document_id")
    texts = load(spark, sf, "speeches", "id", "text").withColumnRenamed("id", "target_id")
    speeches = load(spark, sf, "speeches").select(F.col("id").alias("target_id"), "document_id", F.col("speaker.name").alias("name"), F.col("speaker.country").alias("country"), F.xxhash64("text").alias("h"))
    person = held(bearers(all_names(spark, sf)).select("name", F.col("person").alias("bearer"), F.coalesce(F.regexp_extract("person", r"([^|]*)$", 1), "surname").alias("family")))
    once = cut(speeches.where(F.col("name").isNotNull()).groupBy("document_id", "name", "country", "h").agg(F.min("target_id").alias("target_id")).drop("h"))
    said = held(join_hot(once, person, "name", "inner").join(documents, "document_id").select("target_id", "name", "bearer", "family", "country", "session", "date"))
    listed = held(entries.withColumnRenamed("speaker_name", "typed").join(person.withColumnRenamed("name", "typed"), "typed"))

    def keys(session: str, day: str, near: bool) -> Column:
        """Of an entry (near) all sessions and days that may be meant; of a speech its own."""
        d, s = F.col(day), F.col(session)
        days = F.array(d)
        if near:
            turned = F.try_to_timestamp(F.concat_ws("-", F.year(d), F.date_format(d, "dd"), F.date_format(d, "MM"))).cast("date")
            days = F.concat(F.transform(F.sequence(F.lit(-3), F.lit(3)), lambda k: F.date_add(d, k)), F.array(turned, F.add_months(d, 12), F.add_months(d, -12)))
        sessions = F.array(s, s - 1, s + 1) if near else F.array(s)

        def of(who: str) -> Column:
            each = lambda kind, xs: F.transform(F.array_compact(xs), lambda x: F.concat_ws("|", F.lit(f"{who} {kind}"), who, x.cast("string")))
            return F.concat(each("day", days), each("session", sessions))

        return F.explode(F.array_distinct(F.concat(F.when(F.col("bearer").isNotNull(), of("bearer")).otherwise(F.array().cast("array<string>")), of("family"))))

    left = listed.select("entry_id", keys("ga_session", "meeting_date", True).alias("key"))
    right = said.select("target_id", keys("session", "date", False).alias("key"))
    met = left.join(right, "key").select("entry_id", "target_id").distinct()
    both = met.join(listed.select("entry_id", "country_id", "typed", "ga_session", "meeting_date", F.col("bearer").alias("pa")), "entry_id").join(said.withColumnRenamed("bearer", "pb"), "target_id")
    xs = {
        "x_name": F.when(F.col("pa") == F.col("pb"), F.lit(1.0)).otherwise(F.col("likeness") * 0.8),
        "x_country": country_likeness(state_entries(spark, sf))("country_id", "country"),
        "x_session": F.when(F.col("ga_session").isNull() | F.col("session").isNull(), F.lit(None)).when(F.col("ga_session") == F.col("session"), 1.0).when(F.abs(F.col("ga_session") - F.col("session")) == 1, 0.75).otherwise(0.0),
        "x_date": date_likeness(F.col("meeting_date"), F.col("date")),
    }
    pairs = both.withColumn("likeness", F.pandas_udf(name_likeness, "double")(*(F.when(F.col("pa") == F.col("pb"), F.lit(None)).otherwise(F.col(c)) for c in ("typed", "name")))).select("entry_id", "target_id", *(c.alias(k) for k, c in xs.items()))
    pairs = held(pairs.where(F.col("x_name") >= 0.75))  # where only the surname agrees, initials must too
    sure = pairs.where((F.col("x_name") == 1) & (F.col("x_session") == 1) & (F.col("x_date") == 1)).select("target_id")
    is_address = address_likeness(address_words(texts, sure))
    addresses = texts.select("target_id", F.round(is_address("text"), 1).alias("x_address")).where(F.col("x_address") > 0)  # texts stay where they lie
    pairs = pairs.join(addresses, "target_id", "left").withColumn("x_address", F.coalesce("x_address", F.lit(0.0)))
    start = F.when(F.col("x_name") + F.col("x_address") + sum(F.coalesce(F.col(x), F.lit(0.7)) for x in ("x_country", "x_session", "x_date")) >= 3.9, 0.95).otherwise(0.05)
    return matches(pairs, "entry_id", "target_id", [*xs, "x_address"], start)


# Vetoes: rows and the documents of their meetings.


def number_likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """Of meeting numbers: 1 if equal, less by each misplaced figure, of which two say little in a number of three or less; null if the typed one is missing."""

    def one(x: str | None, y: str | None) -> float | None:
        if not x or not y:
            return None
        d = within(x, y, 2)
        return {0: 1.0, 1: 0.7, 2: 0.4 if len(x) > 3 else 0.1}.get(d, 0.0)

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


def words_likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of the letter triples that two titles have in common, without case and signs; null if one is missing."""

    def grams(x: str) -> set[str]:
        s = "".join(c for c in unaccent(x).lower() if c.isalnum())
        return {s[i : i + 3] for i in range(len(s) - 2)}

    def one(x: str | None, y: str | None) -> float | None:
        if not x or not y:
            return None
        p, q = grams(x), grams(y)
        return round(len(p & q) / len(p | q), 1) if p and q else None

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


def veto_matches(spark: SparkSession, sf: str) -> DataFrame:
    """entry_id, target_id, confidence of vetoes and the documents of their meetings.

    Blocks are the meeting number (typed in the symbol or in the agenda, and with one figure left out, for figures that are wrong, missing or exchanged) and the day, up to three days off. Instalments of one record with one day and title are one target, the first of them.
    """
    number = lambda c: F.regexp_replace(F.regexp_extract(F.regexp_replace(F.upper(c), r"\((?:RESUMPTION|PART)[^)]*\)", ""), r"(?:^|[^\d/])(\d+)\s*(?:TH|ST|ND|RD)?(?:\s*MEETING)?\s*$", 1), "^0+(?=.{3})", "")
    in_agenda = F.coalesce(F.nullif(F.regexp_extract("agenda", r"(?i)meeting\s+(\d{2,})", 1), F.lit("")), F.nullif(F.regexp_extract("agenda", r"(?i)(\d{2,})(?:th|st|nd|rd)\s+meeting", 1), F.lit("")))
    bare_agenda = F.nullif(F.trim(F.regexp_replace(F.regexp_replace("agenda", r"(?i)[;(]?\s*(?:meeting\s+\d+|\d+(?:th|st|nd|rd)\s+meeting)\)?|no title given", ""), r"(?i)^\s*the\s+", "")), F.lit(""))
    v = load(spark, sf, "vetoes", "dppa_id", "date", "meeting_symbol", "agenda")
    v = v.select(F.col("dppa_id").alias("entry_id"), F.col("date").alias("va"), F.coalesce(F.nullif(number(F.col("meeting_symbol")), F.lit("")), in_agenda).alias("na"), bare_agenda.alias("title_a"))
    d = load(spark, sf, "documents", "doc_id", "symbol", "date", "title", "body", "instalment").where(F.col("body") == "SC")
    d = d.groupBy("symbol", F.col("date").alias("vb"), F.col("title").alias("title_b")).agg(F.min(F.struct("instalment", "doc_id")).alias("x"))
    d = held(d.select(F.col("x.doc_id").alias("target_id"), "x.instalment", "vb", F.regexp_extract("symbol", r"(\d+)\D*$", 1).alias("nb"), "title_b"))

    def keys(n: str, day: str, spread: int) -> Column:
        text = F.col(n)
        out = F.when(F.length(text) > 2, F.transform(F.sequence(F.lit(1), F.length(text)), lambda k: F.concat(F.lit("o"), F.substring(text, 1, k - 1), text.substr(k + 1, F.length(text)))))
        days = F.when(F.col(day).isNotNull(), F.transform(F.sequence(F.lit(-spread), F.lit(spread)), lambda k: F.concat(F.lit("d"), F.date_add(F.col(day), k).cast("string"))))
        empty = F.array().cast("array<string>")
        return F.explode(F.array_distinct(F.concat(F.array_compact(F.array(F.concat(F.lit("o"), text))), F.coalesce(out, empty), F.coalesce(days, empty))))

    met = v.select("entry_id", keys("na", "va", 3).alias("key")).join(d.select("target_id", keys("nb", "vb", 0).alias("key")), "key").select("entry_id", "target_id").distinct()
    both = met.join(v, "entry_id").join(d, "target_id")
    near = F.abs(F.datediff("va", "vb"))
    pairs = both.select(
        "entry_id", "target_id", "instalment",
        F.pandas_udf(number_likeness, "double")("na", "nb").alias("x_number"),
        F.when(F.col("va").isNull() | F.col("vb").isNull(), F.lit(None)).when(near == 0, 1.0).when(near <= 3, 1 - 0.1 * near).when((F.year("va") == F.year("vb")) & (near <= 31), 0.3).otherwise(0.0).alias("x_date"),
        F.pandas_udf(words_likeness, "double")("title_a", "title_b").alias("x_title"),
    )
    known = [F.coalesce(F.col(x), F.lit(0.7)) for x in ("x_number", "x_date", "x_title")]
    start = F.when((known[0] >= 0.3) & (known[0] + known[1] + known[2] >= 2.1), 0.95).otherwise(0.05)
    return matches(pairs, "entry_id", "target_id", ["x_number", "x_date", "x_title"], start, prefer="instalment")


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    return debate_matches(spark, sf).select(F.lit("gde").alias("source"), "*").unionByName(veto_matches(spark, sf).select(F.lit("veto").alias("source"), "*"))


@query("p5_found")
def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of both sources with the target that they mean."""
    return _matched(spark, sf).select("source", "entry_id", "target_id")


@query("p5_matches")
def p5_matches(spark: SparkSession, sf: str) -> DataFrame:
    """The matches with their confidence."""
    return _matched(spark, sf).withColumn("confidence", F.round("confidence", 4))
