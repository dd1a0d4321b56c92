"""Mapping of freely typed values to the entries of a reference list."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import Registry
from ..runtime import cut, join_hot
from ..tables import load
from .setjoin import set_join
from .strings import unaccent, within

query = Registry()

#: Least Jaccard similarity of the letter pairs of a value and an entry, and of their word stems.
LEAST, LEAST_STEMS = 0.2, 0.2
#: Letters of a word stem, and letters to which words are cut that are abbreviated.
STEM, CUT = 5, 4
#: A word that stands in so many entries of a list says what kind of thing an entry is, not which.
GENERIC = 3
#: A list must stay under this, as every task holds its generic words and whoever compares with it all its names.
MOST_ENTRIES = 100_000

# Directions and the like, which tell entries with one name apart, and words around a name.
MARKS = ("north", "south", "east", "west", "upper", "lower", "new")
FRAME = ("of", "the", "delegation", "permanent", "mission", "representative", "government")

#: What a value or an entry is reduced to: its core, its marks, its kinds.
Form = tuple[str, str, list[str]]


def _near(word: str, known: tuple[str, ...]) -> str | None:
    if word in known:
        return word
    if len(word) >= 5:
        for w in known:
            if len(w) >= 5 and within(word, w, 1 if len(w) < 8 else 2) is not None:
                return w
    return None


def shortens(token: str, word: str) -> int:
    """2 if the token is a contraction of the word (its letters in order, first and last among them), 1 if it is cut off after three letters or more, else 0."""
    if not 1 < len(token) < len(word) or token[0] != word[0]:
        return 0
    letters = iter(word)
    if token[-1] == word[-1] and all(c in letters for c in token):
        return 2
    return int(len(token) >= 3 and word.startswith(token))


class StateForms:
    """Reduces the names of a list of states, and what is typed for them, to forms. Which words are generic, and how they may be shortened, is learned from the list."""

    def __init__(self, names: Iterable[tuple[int, str]]) -> None:
        of: dict[str, set[int]] = {}
        runs: set[tuple[str, ...]] = set()
        split = [(ref, re.findall(r"[^\W_][\w']*", unaccent(n).lower())) for ref, n in names]
        for ref, words in split:
            for w in words:
                of.setdefault(w, set()).add(ref)
        self.words = frozenset(of)
        self.often = {w: len(refs) for w, refs in of.items() if len(refs) >= GENERIC and w not in FRAME and w not in MARKS and len(w) > 3}
        for _, words in split:
            for k in range(len(words) - 1):
                if words[k] in self.often and words[k + 1] in self.often:
                    runs.add((words[k], words[k + 1]))
        self.kinds = tuple(sorted(self.often, key=lambda w: (-self.often[w], w)))
        self.known = frozenset((*self.kinds, *MARKS, *FRAME))
        self.initials: dict[str, tuple[str, ...]] = {}
        for r in sorted(runs, key=lambda r: (-sum(self.often[w] for w in r), r)):
            self.initials.setdefault("".join(w[0] for w in r), r)
        self.cache: dict[str, list[Form]] = {}

    def full(self, token: str) -> str:
        """The generic word or direction that a token shortens, the token itself if none."""
        if len(token) == 1:
            return next((m for m in MARKS if m[0] == token), token)
        if token in self.words or token in self.known:
            return token
        plain = token.replace("'", "")
        return max(((shortens(plain, w.replace("'", "")), self.often[w], w) for w in self.kinds), default=(0, 0, token), key=lambda x: (x[0], x[1]))[2] if any(shortens(plain, w.replace("'", "")) for w in self.kinds) else token

    def __call__(self, value: str) -> list[Form]:
        """The name of a state without accents, case, brackets, kinds of states and turns like `delegation of`; directions apart. Words that are torn apart, shortened or typed wrong are still known as kinds."""
        if value not in self.cache:
            if len(self.cache) > 100_000:
                self.cache.clear()
            self.cache[value] = self.reduced(value)
        return self.cache[value]

    def reduced(self, value: str) -> list[Form]:
        s = unaccent(value).lower()
        s = re.sub(r"\(spoke\b[^)]*\)?", " ", s)
        s = re.sub(r"-\s*", "", s).replace("&", " and ")
        s = re.sub(r"\b([a-z])\.\s?([a-z])\.(?!\s?[a-z]\.)", lambda m: " ".join(self.initials.get(m[1] + m[2], (m[0],))), s)
        words = [self.full(x.strip("'")) for x in re.findall(r"[^\W_][\w']*", s)]
        joined: list[str] = []
        for w in words:
            if joined and joined[-1] not in self.known and w not in self.known and joined[-1] + w in self.known:
                joined[-1] += w
            elif joined and joined[-1] == "and" and w in self.kinds:
                joined[-1] = w
            else:
                joined.append(w)
        core, kinds, marks = [], set(), set()
        for w in joined:
            if w in FRAME or _near(w, FRAME[2:]):
                continue
            if k := _near(w, self.kinds):
                kinds.add(k)
            elif m := _near(w, MARKS[:-1]):
                marks.add(m)
            else:
                core.append(w)
        return [("".join(core), " ".join(sorted(marks)), sorted(kinds))] if core else []


def forms_of_states(entries: DataFrame) -> StateForms:
    """The forms for a list of entries(value, ref_id), whose size is checked."""
    rows = entries.where(F.col("value").isNotNull()).select("ref_id", "value").limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"the list has more than {MOST_ENTRIES} names")
    return StateForms((r[0], r[1]) for r in rows)


def category_forms(value: str) -> list[Form]:
    """The letters of all words in their order, and those of the words that carry sense in alphabetical order; without a leading `cat:` and a trailing remark."""
    s = unaccent(value).lower()
    s = re.sub(r"^\W*cat\s*:\s*|--\s*general\s*$|\(spoke\b[^)]*\)?", " ", s)
    s = re.sub(r"-\s*\n\s*", "", s)
    words = re.findall(r"[^\W_]+", re.sub(r"'s\b", "", s))
    sense = sorted(w for w in words if w not in ("and", "of", "the", "for", "in", "on", "to"))
    return [(c, "", []) for c in dict.fromkeys(("".join(words), "".join(sense))) if c]


def stems(value: str) -> list[str]:
    """The stems of the words that carry sense."""
    s = re.sub(r"'s\b|-\s*\n\s*", "", unaccent(value).lower())
    return list(dict.fromkeys(w[:STEM] for w in re.findall(r"[^\W\d_]+", s) if w not in ("and", "of", "the", "for", "in", "on", "to")))


def pairs(core: str) -> list[str]:
    """Letter pairs with the rims; a pair that comes again bears a number."""
    seen: Counter[str] = Counter()
    out = []
    for a, b in zip("^" + core, core + "$"):
        seen[a + b] += 1
        out.append(a + b if seen[a + b] == 1 else f"{a}{b}{seen[a + b]}")
    return out


def _formed(df: DataFrame, keep: str, forms: Callable[[str], list[Form]]) -> DataFrame:
    """df(value, ...) with a row for each form of its value: core, marks, kinds, tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(*r, c, m, k, pairs(c)) for r in b.itertuples(index=False, name=None) for c, m, k in forms(r[0])]
            yield pd.DataFrame(rows, columns=[*b.columns, "core", "marks", "kinds", "tokens"])

    return df.mapInPandas(run, f"{keep}, core string, marks string, kinds array<string>, tokens array<string>")


def distances(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edit distance where it is small for these lengths: 0 under 5 letters, 1 under 6, 2 under 9, else 3. Null where it is greater."""
    return pd.Series([within(x, y, 0 if n < 5 else 1 if n < 6 else 2 if n < 9 else 3) for x, y in zip(a, b) for n in (min(len(x), len(y)),)], dtype="Int32")


def common_stems(entries: DataFrame) -> list[str]:
    """The stems that stand in several entries(tokens, ref_id) and so tell none of them from the others; the size of the list is checked."""
    each = entries.select("ref_id", F.explode("tokens").alias("t")).distinct().groupBy("t").agg(F.count("*").alias("n")).where("n > 1")
    rows = each.select("t").limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"the list has more than {MOST_ENTRIES} stems")
    return sorted(r[0] for r in rows)


def map_to_list(records: DataFrame, entries: DataFrame, forms: Callable[[str], list[Form]], least: float = LEAST, by_stems: float | None = None) -> DataFrame:
    """The entry that each value means: value, ref_id (0: none), for each distinct non-null value of records(value).

    entries(value, ref_id) may name an entry in several ways. Letter pairs of the cores meet in a set-similarity join at `least`; the edit distance of the cores (small for their length) and equal marks confirm a pair; of the confirmed ones the best has the highest Jaccard similarity, then the most kinds in common, then the smallest distance, then the lowest ref_id. With `by_stems`, values that have no such entry mean the one whose word stems (without those of several entries) have the highest Jaccard similarity, if that is `by_stems` or more and no second entry has the same. Values without letters, and those that no entry is near enough to, get 0. Values are made distinct first, so repeated ones cost nothing.
    """
    values = cut(_formed(records.select("value").where(F.col("value").isNotNull()).distinct(), "value string", forms))
    named = cut(_formed(entries.select("value", "ref_id").where(F.col("value").isNotNull()).distinct(), "value string, ref_id long", forms))
    left = values.groupBy(F.col("core").alias("left")).agg(F.first("tokens").alias("tokens"))  # equal cores have equal tokens
    right = named.groupBy(F.col("core").alias("right")).agg(F.first("tokens").alias("tokens"))
    near = set_join(left, right, least).withColumn("d", F.pandas_udf(distances, "int")("left", "right")).where(F.col("d").isNotNull())
    v = values.select("value", F.col("core").alias("left"), F.col("marks").alias("vm"), F.col("kinds").alias("vk"))
    e = named.select(F.col("core").alias("right"), "ref_id", F.col("marks").alias("em"), F.col("kinds").alias("ek"))
    both = F.size(F.array_union("vk", "ek"))
    kin = F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect("vk", "ek")) / both)
    found = v.join(near, "left").join(e, "right").where(F.col("vm") == F.col("em"))
    best = found.groupBy("value").agg(F.min(F.struct((-F.col("jaccard")).alias("j"), (-kin).alias("k"), "d", "ref_id")).alias("b")).select("value", "b.ref_id")
    every = records.select("value").where(F.col("value").isNotNull()).distinct()
    if by_stems is not None:
        best = cut(best)
        stemmed = F.pandas_udf(lambda x: x.map(stems), "array<string>")
        with_stems = cut(entries.where(F.col("value").isNotNull()).select(stemmed("value").alias("tokens"), "ref_id"))
        shared = F.array(*map(F.lit, common_stems(with_stems))).cast("array<string>")
        telling = lambda c: F.when(F.size(F.array_except(c, shared)) > 0, F.array_except(c, shared)).otherwise(F.col(c))
        rest = every.join(best, "value", "left_anti").select(F.col("value").alias("left"), stemmed("value").alias("tokens")).withColumn("tokens", telling("tokens"))
        listed = with_stems.withColumn("tokens", telling("tokens")).groupBy(F.array_sort("tokens").alias("tokens")).agg(F.min("ref_id").alias("right"), F.countDistinct("ref_id").alias("n")).where("n = 1").drop("n")
        listed = cut(listed.select(F.concat_ws(" ", "tokens").alias("named"), "tokens", "right"))
        met = set_join(rest, listed.select(F.col("named").alias("right"), "tokens"), by_stems).join(listed.select(F.col("named").alias("right"), F.col("right").alias("ref_id")), "right")
        top = met.groupBy("left", "ref_id").agg(F.max("jaccard").alias("j")).groupBy("left").agg(F.max(F.struct("j", "ref_id")).alias("hi"), F.max(F.struct("j", (-F.col("ref_id")).alias("r"))).alias("lo"))
        best = best.unionByName(top.where(F.col("hi.ref_id") == -F.col("lo.r")).select(F.col("left").alias("value"), "hi.ref_id"))
    return every.join(best, "value", "left").select("value", F.coalesce("ref_id", F.lit(0)).cast("long").alias("ref_id"))


def state_entries(spark: SparkSession, sf: str) -> DataFrame:
    m = load(spark, sf, "member_states", "state_id", "member_state", "iso_code", "other_names", "earlier_name")
    names = F.array_compact(F.concat(F.array("member_state", "iso_code", "earlier_name"), F.coalesce(F.split("other_names", r"\|"), F.array().cast("array<string>"))))
    return m.select(F.explode(names).alias("value"), F.col("state_id").alias("ref_id"))


def category_entries(spark: SparkSession, sf: str, thesaurus: DataFrame | None = None) -> DataFrame:
    """The categories, and each with its words cut short; thesaurus(category, other) may name them in other words."""
    listed = load(spark, sf, "category_list", "category_id", "category")
    word = F.split("category", " ")
    short = F.array_join(F.transform(word, lambda w: F.substring(w, 1, CUT)), " ")
    own = listed.select(F.explode(F.array("category", short)).alias("value"), F.col("category_id").alias("ref_id"))
    if thesaurus is None:
        return own
    return own.unionByName(listed.join(thesaurus, "category").select(F.col("other").alias("value"), F.col("category_id").alias("ref_id")))


def _records(spark: SparkSession, sf: str, field: str) -> DataFrame:
    if field == "speaker_country":
        return load(spark, sf, "speeches").select(F.col("id").alias("record_id"), F.col("speaker.country").alias("value"))
    table, column = {"country_name": ("countries", "name"), "category": ("resolutions", "category")}[field]
    return load(spark, sf, table).select(F.col("id").alias("record_id"), F.col(column).alias("value"))


def listed(spark: SparkSession, sf: str) -> DataFrame:
    """field, record_id, value, ref_id of all values that are no entry character for character."""
    states = load(spark, sf, "member_states").select(F.col("member_state").alias("value"))
    categories = load(spark, sf, "category_list").select(F.col("category").alias("value"))
    out = None
    named = state_entries(spark, sf)
    for fields, clean, entries, forms, by_stems in ((("speaker_country", "country_name"), states, named, forms_of_states(named), None), (("category",), categories, category_entries(spark, sf), category_forms, LEAST_STEMS)):
        typed = None
        for f in fields:
            one = _records(spark, sf, f).where(F.col("value").isNotNull()).join(clean, "value", "left_anti").select(F.lit(f).alias("field"), "record_id", "value")
            typed = one if typed is None else typed.unionByName(one)
        mapped = join_hot(typed, cut(map_to_list(typed, entries, forms, by_stems=by_stems)), "value", "inner")
        out = mapped if out is None else out.unionByName(mapped)
    return out


@query("p1_found")
def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """For each typed value that is no entry character for character the entry that it means, 0 for none."""
    return listed(spark, sf).select("field", "record_id", "ref_id")


@query("p1_unmatched")
def p1_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """The values that no entry is meant by, with the number of records."""
    return listed(spark, sf).where(F.col("ref_id") == 0).groupBy("field", "value").agg(F.count("*").alias("records"))
