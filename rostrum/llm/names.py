"""Variant spellings of persons' names: a pigeonhole segment join, and the linking of short forms to the one person who may bear them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans import Registry
from ..runtime import cut, held
from ..tables import load
from .strings import unaccent, within

query = Registry()

#: Edits that two spellings of a surname may differ by; an exchange of neighbours is one.
EDITS = 2
#: Surnames under LEAST_LETTERS must agree, those under SHORT may differ by one edit only; under SHORT_ALONE where no given name but an initial or nothing stands with them.
LEAST_LETTERS, SHORT, SHORT_ALONE = 4, 7, 8
#: A word is a given name, or a middle name, if it stands in that place in this share of the distinct names; so there are at most 1 / SHARE of them.
SHARE = 1 / 400
#: What makes a first word a short form of a given name: under so large a share of the surnames that bear it, and one other first word at most, the other word is the given name, under two such surnames at least and this share of all names.
COVER, SHORT_FORM_SHARE = 0.5, 1 / 50_000

# Titles, name particles, offices and their fillers.
TITLES = frozenset(("mr", "mrs", "ms", "miss", "dr", "sir", "dame", "prof", "he", "h.e", "madam", "mme", "amb", "ambassador"))
PARTICLES = frozenset(("van", "von", "de", "da", "di", "del", "der", "den", "la", "le", "el", "al", "bin", "ibn"))
OFFICE = frozenset(("the", "acting", "vice", "deputy", "president", "chair", "chairman", "chairperson", "secretary", "general", "secretary-general", "vice-president", "rapporteur", "speaker", "moderator", "observer", "representative"))


def name_tokens(name: str) -> tuple[list[str], list[bool], int]:
    """Words without titles, accents and case; whether each is written in capitals only; and how many stand before a comma (-1: none)."""
    s = unaccent(name.replace("\xa0", " "))
    s = re.sub(r"(?<=\w)-\s+", "", s)
    s = re.sub(r"\bH\.?\s?E\.?(?=\s)", " ", s)
    s = re.sub(r"(?<=\w\.)(?=\w\.)", " ", s)
    words, upper, comma = [], [], -1
    for part in re.findall(r",|[^\s,]+", s):
        if part == ",":
            comma = len(words) if comma < 0 and words else comma
            continue
        w = part.lower().strip("\"'()[];:").replace("0", "o").replace("1", "l").replace("5", "s")
        if not words and w.rstrip(".") in TITLES and (len(w) > 2 or w.endswith(".") or w in ("mr", "ms", "dr")):
            continue
        if w:
            words.append(w)
            upper.append(part.isupper() and len(part.strip(".")) > 1)
    return words, upper, comma


def begun(word: str, given: frozenset[str]) -> list[str]:
    """The given names that a word of two to five letters begins, and that are longer by two letters or more: an abbreviation."""
    return sorted(g for g in given if g.startswith(word) and len(g) >= len(word) + 2) if 2 <= len(word) <= 5 else []


def is_office(words: list[str]) -> bool:
    return not words or all(w.strip(".") in OFFICE for w in words)


def known(word: str, among: frozenset[str], nick: frozenset[str] = frozenset()) -> str | None:
    """The given name that a word is, or nearly is; short forms (nick) are none."""
    if word in among:
        return word
    if len(word) < 4 or word in nick:
        return None
    for k in (1, 2):
        if k == 2 and len(word) < 6:
            break
        near = [g for g in among if len(g) >= 4 and within(word, g, k) is not None]
        if near:
            return near[0] if len(near) == 1 else None
    return None


def joined_surname(words: list[str]) -> str:
    return "".join(w.strip(".'").replace("'", "").replace("-", "") for w in words)


#: name, kind, given, middle, surname; kind is `full` (given and surname), `short` (initial or short form, and surname) or `bare` (surname).
Parsed = tuple[str, str, str, str, str]


def parse_name(name: str, given: frozenset[str], middle: frozenset[str], nick: frozenset[str] = frozenset()) -> Parsed | None:
    words, upper, comma = name_tokens(name)
    if is_office(words):
        return None
    if 0 < comma < len(words):  # surname first
        last, first = words[:comma], words[comma:]
    elif any(upper) and not all(upper):
        last = [w for w, u in zip(words, upper) if u]
        first = [w for w, u in zip(words, upper) if not u]
        particles = [w for w in first if w in PARTICLES and words.index(w) + 1 < len(words) and upper[words.index(w) + 1]]
        last, first = particles + last, [w for w in first if w not in particles]
    else:
        head = words[0]
        n = 0
        if len(words) > 1 and (known(head, given, nick) or head in nick or begun(head.strip(".'"), given) or re.fullmatch(r"[a-z]\.?", head)):
            n = 1
        elif len(words) > 1 and not all(upper) and words[-1] in given:
            return parse_name(f"{' '.join(words[:-1])}, {words[-1]}", given, middle, nick)
        elif len(words) > 2 and known(words[0] + words[1], given, nick):  # a given name torn apart
            words = [words[0] + words[1], *words[2:]]
            n = 1
        while n and n < len(words) - 1 and (words[n] in middle or re.fullmatch(r"[a-z]\.", words[n])):
            n += 1
        first, last = words[:n], words[n:]
    if first and not last:
        first, last = [], first
    surname = joined_surname(last)
    if not surname:
        return None
    if len(first) > 1 and not known(first[0], given, nick) and (joined := known("".join(first[:2]), given, nick)):
        first = [joined, *first[2:]]
    if not first:
        return name, "bare", "", "", surname
    head = first[0].strip(".'")
    mid = next((w.strip(".") for w in first[1:] if w.strip(".")), "")
    if (g := known(head, given, nick)) is not None:
        return name, "full", g, mid, surname
    if head in nick or len(head) == 1 or begun(head, given):
        return name, "short", head, mid, surname
    return name, "full", head, mid, surname


def lexicons(names: DataFrame, share: float) -> tuple[frozenset[str], frozenset[str], int]:
    """Given and middle names: words that are first, or second of three or more, in at least `share` of the distinct names. At most 1 / share of each come to the driver. And the number of names."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for n in b["name"]:
                rows.append(("all", ""))
                w, upper, comma = name_tokens(n)
                if comma < 0 and len(w) > 1 and not upper[0] and not is_office(w):
                    rows.append(("given", w[0]))
                    if len(w) > 2 and len(w[1]) > 2 and w[1] not in PARTICLES:
                        rows.append(("middle", w[1]))
            yield pd.DataFrame(rows, columns=["place", "word"])

    counts = names.mapInPandas(run, "place string, word string").groupBy("place", "word").agg(F.count("*").alias("n"))
    counts = cut(counts)
    total = counts.where("place = 'all'").first()
    total = total["n"] if total else 0
    often = [(r[0], r[1]) for r in counts.where((F.col("n") >= max(2.0, total * share)) & (F.length("word") > 1)).collect()]
    given = frozenset(w for p, w in often if p == "given" and "." not in w)
    return given, frozenset(w for p, w in often if p == "middle" and w not in given and "." not in w), total


def short_forms(names: DataFrame, middle: frozenset[str], total: int, cover: float = COVER, share: float = SHORT_FORM_SHARE) -> dict[str, tuple[str, ...]]:
    """The short forms of given names that the names themselves show: `Vasya` is one of `Vasily` if most surnames that stand with Vasya, and with one other first word at most, stand with Vasily.

    Relatives share surnames too, but each with another first word, so that no pair of given names is as frequent. The rarer word of a pair is the short form; a word may be short for several names. Counted by surname, in one aggregation, without pairs; as a short form stands in `share` of the names at least, 1 / share of them at most come to the driver.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name in b["name"]:
                w, upper, comma = name_tokens(name)
                if comma >= 0 or len(w) < 2 or upper[0] or is_office(w) or w[0] in PARTICLES or len(w[0].strip(".'")) < 2 or "." in w[0]:
                    continue
                n = 1
                while n < len(w) - 1 and (w[n] in middle or re.fullmatch(r"[a-z]\.", w[n])):
                    n += 1
                rows.append((w[0], joined_surname(w[n:])))
            yield pd.DataFrame(rows, columns=["head", "tail"])

    by_tail = names.mapInPandas(run, "head string, tail string").distinct().groupBy("tail").agg(F.count("*").alias("n"), F.min("head").alias("lo"), F.max("head").alias("hi")).where("n <= 2")
    two = F.col("n") == 2
    sides = F.array_compact(F.array(F.struct(F.col("lo").alias("h"), F.when(two, F.col("hi")).alias("g")), F.when(two, F.struct(F.col("hi").alias("h"), F.col("lo").alias("g")))))
    counts = by_tail.select(F.explode(sides).alias("x")).groupBy("x.h", "x.g").agg(F.count("*").alias("c"))
    often = F.when((F.col("c") >= 2) & F.col("g").isNotNull(), F.struct("g", "c"))
    totals = counts.groupBy("h").agg(F.sum("c").alias("t"), F.collect_list(often).alias("with"))
    found = totals.where(F.expr(f"aggregate(with, 0L, (a, x) -> a + x.c) >= {cover} * t") & (F.col("t") >= total * share))
    rows = {r["h"]: (r["t"], [(x["g"], x["c"]) for x in r["with"]]) for r in found.collect()}
    out = {h: tuple(sorted(g for g, c in with_ if c >= 0.1 * t and not (g in rows and rows[g][0] <= t))) for h, (t, with_) in rows.items()}
    typo = lambda h, g: len(h) > 3 and within(h, g, 1 if len(h) < 6 else 2) is not None
    return {h: means for h, means in out.items() if not all(typo(h, g) for g in means)}


def allowed(n: int, short: int, edits: int) -> int:
    """By how many edits two texts may differ of which the shorter has n letters."""
    return min(edits, 0 if n < LEAST_LETTERS else 1 if n < short else edits)


def segments(n: int, k: int) -> list[tuple[int, int]]:
    """Place and length of the k + 1 segments of a text of n letters; the last ones are the longer ones."""
    base, more = divmod(n, k + 1)
    sizes = [base + (i >= k + 1 - more) for i in range(k + 1)]
    return [(sum(sizes[:i]), size) for i, size in enumerate(sizes)]


def index_keys(s: str, edits: int, shortest: int, longest: int) -> list[str]:
    """Keys of s in the inverted index: of each number of edits that may come into question (limits of one edit lie from `shortest` to `longest` letters), length, number and text of each segment."""
    n = len(s)
    ks = {allowed(m, short, edits) for m in range(max(1, n - edits), n + 1) for short in (shortest, longest)}
    return [f"{k}|{n}|{i}|{s[at : at + size]}" for k in sorted(ks) if k < n for i, (at, size) in enumerate(segments(n, k))]


def lookup_keys(s: str, edits: int, short: int) -> list[str]:
    """Keys by which s finds every text within the edits that are allowed.

    Of two texts within k edits, one of the k + 1 segments of the indexed one stands whole in the other, shifted by no more letters than there may be edits before it and after it. Only an exchange of the two letters at a border spoils two segments; so each exchange at a border is undone as well, and the segments at its sides are looked up.
    """
    m, out = len(s), []
    for n in range(max(1, m - edits), m + edits + 1):
        k, delta = allowed(min(m, n), short, edits), m - n
        if abs(delta) > k or k >= n:
            continue
        parts = segments(n, k)
        for i, (at, size) in enumerate(parts):
            for p in range(max(0, at - i, at + delta - (k - i)), min(m - size, at + i, at + delta + (k - i)) + 1):
                out.append(f"{k}|{n}|{i}|{s[p : p + size]}")
        for i in range(1, k + 1) if abs(delta) < k else ():
            (a, la), (b, lb) = parts[i - 1], parts[i]
            for q in {b, b + delta}:
                if 0 < q < m and s[q - 1] != s[q]:
                    t = s[: q - 1] + s[q] + s[q - 1] + s[q + 1 :]
                    if q >= la:
                        out.append(f"{k}|{n}|{i - 1}|{t[q - la : q]}")
                    if q + lb <= m:
                        out.append(f"{k}|{n}|{i}|{t[q : q + lb]}")
    return list(dict.fromkeys(out))


def segment_join(left: DataFrame, right: DataFrame, edits: int = EDITS, shortest: int = SHORT, longest: int = SHORT_ALONE) -> DataFrame:
    """Pairs of rows of left(block, a, short, ...) and right(block, b, ...) in one block whose texts a and b are d edits apart (exchange of neighbours is one), d as `allowed` for `short`, which lies from shortest to longest. Other columns come along; their names must differ. Rows of either side must be distinct. Null texts match nothing.

    Each text of right is cut into segments, one more than there may be edits; the texts of left look their shifted substrings up, and a banded edit distance verifies the pairs.
    """

    def keyed(df: DataFrame, index: bool) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if index:
                    keys = [[f"{x}|{k}" for k in index_keys(t, edits, shortest, longest)] for x, t in zip(b["block"], b["b"])]
                else:
                    keys = [[f"{x}|{k}" for k in lookup_keys(t, edits, s)] for x, t, s in zip(b["block"], b["a"], b["short"])]
                yield b.assign(key=keys).explode("key").dropna(subset=["key"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return df.where(F.col("b" if index else "a").isNotNull()).mapInPandas(run, f"{schema}, key string")

    def distances(a: pd.Series, b: pd.Series, short: pd.Series) -> pd.Series:
        return pd.Series([within(x, y, allowed(min(len(x), len(y)), s, edits)) for x, y, s in zip(a, b, short)], dtype="Int32")

    met = keyed(left, False).join(keyed(right, True).drop("block"), "key").drop("key").distinct()
    # an exchange of neighbours counts as two edits there
    near = F.when(F.least(F.length("a"), F.length("b")) < F.col("short"), F.levenshtein("a", "b", 2 * min(1, edits))).otherwise(F.levenshtein("a", "b", 2 * edits))
    met = met.where(near >= 0)
    return met.withColumn("d", F.pandas_udf(distances, "int")("a", "b", "short")).where(F.col("d").isNotNull())


def roots(parents: DataFrame) -> DataFrame:
    """node, root: follows parents(node, parent) to the end; parents without a row are roots. Pointers double in each round, and each round is written to the shared folder."""
    state = parents.select("node", F.col("parent").alias("root"))
    while True:
        up = state.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = held(state.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        state = step.select("node", "root")
        if step.where("moved").isEmpty():
            return state


def parsed_names(names: DataFrame, share: float, nicknames: dict[str, tuple[str, ...]] | None) -> DataFrame:
    """name, kind, given, middle, surname, blocks, plain, n of each distinct name that means a person. blocks: where the segment join looks the surname up; plain: the name without titles and blanks."""
    distinct = held(names.where(F.col("name").isNotNull()).groupBy("name").agg(F.sum("n").alias("n")))
    heads, middle, total = lexicons(distinct, share)
    nick = short_forms(distinct, middle, total) | (nicknames or {})
    given = frozenset(w for w in heads if w not in nick)
    shorts = frozenset(nick)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for x, n in zip(b["name"], b["n"]):
                if (p := parse_name(x, given, middle, shorts)) is None:
                    continue
                _, kind, g, m, surname = p
                blocks = ["*"] if kind == "bare" else [f"g:{g}"] if kind == "full" else [f"i:{g}"] if len(g) == 1 else [f"g:{y}" for y in nick.get(g, begun(g, given))]
                plain = " ".join(re.sub(r"\b(?:h\.\s?e|amb|mr|mrs|ms|dr)\.", " ", x.replace("\xa0", " "), flags=re.IGNORECASE).split())
                rows.append((x, kind, g, m, surname, blocks, plain, n))
            yield pd.DataFrame(rows, columns=["name", "kind", "given", "middle", "surname", "blocks", "plain", "n"])

    return held(distinct.mapInPandas(run, "name string, kind string, given string, middle string, surname string, blocks array<string>, plain string, n long"))


def bearers(names: DataFrame, share: float = SHARE, edits: int = EDITS, nicknames: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """name, person, surname for each distinct name of names(name, n) that means a person; names of one person get the same person, short forms that several persons may bear get none.

    Full names with one given name (as the corpus' given names are spelt) and surnames within `edits` are spellings of each other: each attaches to the nearest one that more records bear, unless it comes in several forms itself (a misspelling is written once, a person's own name in many ways). Initials and short forms with a surname, and surnames alone, attach to a person only if exactly one may bear them, by the surname as it is spelt somewhere, or else by the nearest within `edits`. Names that only give an office, null and empty names get none. A misspelling with a middle name attaches only to a name with the same; a short form with a middle initial may lack it in the person's name.

    Given names and their short forms are learned from the names; `nicknames` may add others (short form: given names). One segment join finds the neighbours of all kinds of names.
    """
    parsed = parsed_names(names, share, nicknames)
    full = F.col("kind") == "full"
    node = F.concat_ws("|", "given", "surname")
    nodes = parsed.where(full).groupBy("given", "surname").agg(F.sum("n").alias("n"), F.max("middle").alias("middle"), F.countDistinct("plain").alias("forms"))
    initial = F.substring("middle", 1, 1)
    right = nodes.select(node.alias("nb"), F.col("given").alias("gb"), F.col("surname").alias("b"), F.col("n").alias("n_b"), initial.alias("mb"), F.explode(F.array(F.concat(F.lit("g:"), "given"), F.concat(F.lit("i:"), F.substring("given", 1, 1)), F.lit("*"))).alias("block"))
    # who looks up: full names of one form, and all others
    once = nodes.where("forms = 1").select(node.alias("na"), F.lit("full").alias("ka"), F.lit("").alias("ga"), F.col("surname").alias("a"), "n", initial.alias("ma"), F.lit(SHORT).alias("short"), F.concat(F.lit("g:"), "given").alias("block"))
    asks = parsed.where(~full).select(node.alias("na"), F.col("kind").alias("ka"), F.col("given").alias("ga"), F.col("surname").alias("a"), F.lit(0).cast("long").alias("n"), F.col("middle").alias("ma"), F.when(F.length("given") > 1, SHORT).otherwise(SHORT_ALONE).alias("short"), F.explode("blocks").alias("block")).distinct()
    left = once.unionByName(asks.withColumn("ma", F.coalesce("ma", F.lit(""))))
    met = segment_join(left, right, edits)
    own = F.col("ka") == "full"
    higher = (F.col("n_b") > F.col("n")) | ((F.col("n_b") == F.col("n")) & (F.col("b") < F.col("a")))
    met = met.where(F.when(own, (F.col("na") != F.col("nb")) & higher & ((F.col("ma") == "") | (F.col("ma") == F.col("mb")))).otherwise((F.col("ma") == "") | (F.col("mb") == "") | (F.col("mb") == F.substring("ma", 1, 1))))
    met = held(met.select("ka", "ga", "ma", "a", "na", "nb", "b", "n_b", "d"))

    best = met.where(own).groupBy("na").agg(F.min(F.struct("d", (-F.col("n_b")).alias("o"), "b", "nb")).alias("x"))
    root = roots(best.select(F.col("na").alias("node"), F.col("x.nb").alias("parent")))
    # one person only at the least distance: the first and the last of its hashes are the same
    fits = met.where(~own).select("ka", F.col("ga").alias("given"), F.col("ma").alias("middle"), F.col("a").alias("surname"), F.col("nb").alias("node"), "d").join(root, "node", "left").withColumn("person", F.coalesce("root", "node"))
    least = lambda sign: F.min(F.struct("d", (sign * (F.xxhash64("person") % (1 << 62))).alias("h"), "person"))
    found = fits.groupBy("given", "middle", "surname").agg(least(1).alias("lo"), least(-1).alias("hi"))
    found = found.select("given", "middle", "surname", F.col("lo.person").alias("borne"), (F.col("lo.person") == F.col("hi.person")).alias("only"))
    # names that nobody bears: equal short forms are one person's, to whom a surname alone belongs if there is one only
    rest = parsed.where(~full).select("name", "kind", "given", "middle", "surname").join(found, ["given", "middle", "surname"], "left")
    short = F.col("kind") == "short"
    alone = F.when(short & F.col("borne").isNull(), F.concat_ws("|", F.lit("~"), "given", "surname"))
    by_surname = Window.partitionBy("surname")
    rest = rest.withColumn("alone", alone).withColumn("first", F.min("alone").over(by_surname)).withColumn("last", F.max("alone").over(by_surname))
    lone = F.concat(F.lit("~|"), "surname")
    person = F.when(F.col("only"), F.col("borne")).when(short, F.col("alone")).when(F.col("borne").isNotNull(), lone).when(F.col("first") == F.col("last"), F.col("first")).otherwise(lone)
    rest = rest.select("name", person.alias("person"), "surname")
    return parsed.where(full).select("name", node.alias("node"), "surname").join(root, "node", "left").select("name", F.coalesce("root", "node").alias("person"), "surname").unionByName(rest)


def link_names(names: DataFrame, share: float = SHARE, edits: int = EDITS, nicknames: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """name, person of the names whose bearer is known; see bearers."""
    return bearers(names, share, edits, nicknames).where(F.col("person").isNotNull()).select("name", "person")


def all_names(spark: SparkSession, sf: str) -> DataFrame:
    """The strings of the three columns with their numbers of records."""
    s = load(spark, sf, "speeches").select(F.col("speaker.name").alias("name"))
    g = load(spark, sf, "general_debate_entries", "speaker_name").withColumnRenamed("speaker_name", "name")
    r = load(spark, sf, "sc_representatives", "name")
    return s.unionByName(g).unionByName(r).groupBy("name").agg(F.count("*").alias("n"))


#: Persons with more spellings are split before their pairs are formed.
SPLIT = 1000


@query("p2_found")
def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of different strings that mean one person. The spellings of a person with more than SPLIT of them are spread over several tasks, each of which pairs its part with all."""
    linked = held(link_names(all_names(spark, sf)))
    parts = F.ceil(F.count("*").over(Window.partitionBy("person")) / SPLIT).cast("int")
    sized = linked.withColumn("parts", parts)
    a = sized.select("person", F.pmod(F.xxhash64("name"), F.col("parts")).cast("int").alias("part"), F.col("name").alias("name_a"))
    b = sized.select("person", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("name").alias("name_b"))
    return a.join(b, ["person", "part"]).where(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")


@query("p2_persons")
def p2_persons(spark: SparkSession, sf: str) -> DataFrame:
    """Each name with its person, and how many spellings this has."""
    linked = held(link_names(all_names(spark, sf)))
    return linked.join(linked.groupBy("person").agg(F.count("*").alias("spellings")), "person")
