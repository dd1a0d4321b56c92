"""Text functions of meeting records as column expressions; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stay in lower case in titles; numbers, ordinals and months in words.
SMALL_WORDS = ("a", "an", "the", "of", "for", "in", "on", "at", "by", "to", "and", "or", "nor", "but", "as", "with", "from")
UNITS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth", "eighteenth", "nineteenth")
TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where the value is computed once however often `use` names it (inside lambdas nothing else shares it)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank_to_null(c: Column) -> Column:
    """Trimmed, null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def extracted(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without one."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def words(c: Column) -> Column:
    """Words between white space; none of an empty or blank text."""
    return F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")


def normalize_allcaps(c: Column) -> Column:
    """Text whose letters are capitals by more than four fifths becomes title case; small words stay in lower case unless they come first, and white space is squeezed. Other text stays."""
    letters, upper = F.regexp_count(c, F.lit("[A-Za-z]")), F.regexp_count(c, F.lit("[A-Z]"))

    def titled(w: Column) -> Column:  # every run of letters begins with a capital
        runs = F.regexp_extract_all(F.lower(w), F.lit(r"([a-z]+|[^a-z]+)"), F.lit(1))
        return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1_000_000))), "")

    cased = F.transform(words(c), lambda w, i: F.when((i > 0) & F.lower(w).isin(*SMALL_WORDS), F.lower(w)).otherwise(titled(w)))
    return F.when((letters > 0) & (upper > letters * 0.8), F.array_join(cased, " ")).otherwise(c)


def repair_hyphenation(c: Column) -> Column:
    """Joins a word divided at a hyphen before white space and a small letter (fixed value: the pattern)."""
    return F.regexp_replace(c, r"([A-Za-z])-[ \t\n]+([a-z])", "$1$2")


def strip_print_codes(c: Column) -> Column:
    """Without job numbers of the printer (fixed value: their form), and with two line ends at most."""
    return F.regexp_replace(F.regexp_replace(c, r"\b\d{2}-\d{5}(?:\s*\([A-Z]\))?", ""), r"\n{3,}", "\n\n")


def wordlike_counts(c: Column) -> tuple[Column, Column]:
    """Tokens with a letter, and of these the word-like ones: two ASCII letters or more, and half of the characters."""
    tokens = F.filter(words(c), lambda w: w.rlike("[A-Za-z]"))
    n = lambda w: F.length(F.regexp_replace(w, "[^A-Za-z]+", ""))
    return F.size(tokens), F.size(F.filter(tokens, lambda w: ~w.rlike("[^A-Za-z]") & (F.length(w) >= 2) | (n(w) >= 2) & (n(w) * 2 >= F.length(w))))


def quality_score(c: Column) -> Column:
    """T4: share of word-like tokens, to four places; 0 under fifty tokens."""
    return let(F.struct(*(x.alias(n) for n, x in zip(("alpha", "good"), wordlike_counts(c)))), lambda x: quality_of(x["alpha"], x["good"]))


def quality_of(alpha: Column, good: Column) -> Column:
    """T4: the score that counts of tokens give."""
    return F.when(alpha < 50, 0.0).otherwise(F.round(good / alpha, 4))


def quality_label(score: Column) -> Column:
    return F.when(score >= 0.7, "good").when(score >= 0.4, "poor").otherwise("unusable")


def record_symbol(c: Column) -> Column:
    """T5."""
    return extracted(c, r"\b([AS]/(?:\d+/)?PV\.\d+)\b")


def session_of(symbol: Column) -> Column:
    """The session in an assembly's symbol."""
    return F.try_to_number(extracted(symbol, r"^A/(\d+)/"), F.lit("999")).cast("int")


def number_of(symbol: Column) -> Column:
    return extracted(symbol, r"PV\.(\d+)").cast("int")


def ordinal_years() -> dict[str, int]:
    """`seventythird` and the like, without hyphen and space, up to the hundredth."""
    out = {w: k for k, w in enumerate(ORDINALS, 1)} | {t[:-1] + "ieth": 10 * k for k, t in enumerate(TENS, 2)}
    return out | {t + w: 10 * k + j for k, t in enumerate(TENS, 2) for j, w in enumerate(ORDINALS[:9], 1)} | {"onehundredth": 100}


def ordinal_year(c: Column) -> Column:
    """The year of a body that is spelt out."""
    bare = F.regexp_replace(F.lower(extracted(c, r"(?i)\b((?:one[ -])?[a-z]+(?:[ -][a-z]+)?)[ -]+year\b")), "[ -]", "")
    table = F.create_map(*(F.lit(x) for kv in ordinal_years().items() for x in kv))
    last = F.regexp_replace(F.lower(extracted(c, r"(?i)\b([a-z]+)[ -]+year\b")), "[ -]", "")
    return F.coalesce(F.try_element_at(table, bare), F.try_element_at(table, last))


def meeting_number(c: Column) -> Column:
    """From the symbol, else `9453rd plenary meeting`."""
    return F.coalesce(number_of(record_symbol(c)), extracted(c, r"(?i)\b(\d+)(?:st|nd|rd|th) (?:plenary )?meeting").cast("int"), extracted(c, r"(?i)\b(\d+)(?:st|nd|rd|th) plenary").cast("int"))


def location(c: Column) -> Column:
    """T9."""
    u = F.upper(c)
    return F.when(u.contains("NEW YORK"), "New York").when(u.contains("GENEVA"), "Geneva")


def body_of(symbol: Column) -> Column:
    """T11."""
    return F.when(symbol.startswith("A/"), "GA").when(symbol.startswith("S/"), "SC")


def spelled_date(c: Column) -> Column:
    """`13 September 2010`; `I September` is the first. Null outside 1945 to 2100 and for days that don't exist."""
    months = "|".join(MONTHS)
    pattern = rf"\b(\d{{1,2}}|I) ({months}) (\d{{4}})\b"
    day = F.regexp_replace(extracted(c, pattern, 1), "I", "1")
    date = F.try_to_date(F.concat_ws(" ", day, extracted(c, pattern, 2), extracted(c, pattern, 3)), "d MMMM yyyy")
    return F.when(F.year(date).between(1945, 2100) & day.isNotNull(), date)


def any_date(c: Column) -> Column:
    """The first of some formats that fits."""
    return F.coalesce(*(F.try_to_date(c, f) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy")))


def short_year_date(c: Column) -> Column:
    """`11/16/45`; a year that would lie ahead belongs to the last century."""
    d = F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "M/d/yy"))
    return F.when(d > F.current_date(), F.add_months(d, -1200)).otherwise(d)


def plausible_year(date: Column, session: Column, before: int = 0, after: int = 2) -> Column:
    """The session's year, give or take."""
    return (F.year(date) - (1945 + session)).between(-before, after)


def normalise_name(c: Column) -> Column:
    """Without years of life; `Last, First` turned."""
    s = F.trim(F.regexp_replace(c, r",?\s*\(?\b(?:1[89]|20)\d{2}\s*-\s*(?:(?:1[89]|20)\d{2})?\)?", ""))
    return F.when(F.instr(s, ",") > 0, F.trim(F.concat_ws(" ", F.trim(F.regexp_extract(s, r",\s*(.*)$", 1)), F.trim(F.regexp_extract(s, r"^([^,]*)", 1))))).otherwise(s)


#: Longer parts of a list are text, no names.
NAME_CHARS = 80


def _names(parts: Column) -> Column:
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: (p != "") & (F.lower(p) != "none") & (F.length(p) <= NAME_CHARS))


def country_list(c: Column) -> Column:
    """The names of a list of states. Without commas, `and` parts two names; with commas, only the last of several `and` in a part does, as names hold one themselves. `None` and an empty list give none; parts over NAME_CHARS characters are text."""
    s = F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), r"\.+$", "")
    last = lambda p: F.split(F.regexp_replace(p, r"(?i)^(.*\sand\s.*)\sand\s(.*)$", "$1\n$2"), "\n")
    parts = lambda x: F.when(F.instr(x, ",") > 0, F.flatten(F.transform(F.split(x, r"\s*,\s*"), last))).otherwise(F.split(x, r"\s+and\s+"))
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(let(s, lambda x: _names(parts(x))))


def sponsor_list(c: Column) -> Column:
    """The names of a list of sponsors, which commas and `and` part; what ends the sentence goes."""
    s = F.regexp_replace(F.trim(c), r"[\s.;]+$", "")
    return F.when(s.isNull(), F.array().cast("array<string>")).otherwise(_names(F.split(s, r"\s*,\s*(?:and\s+)?|\s+and\s+")))


COUNT = r"(\d+|none|zero|" + "|".join(UNITS) + ")"


def vote_count(c: Column) -> Column:
    """A count in figures or words."""
    table = F.create_map(*(F.lit(x) for kv in ({"none": 0, "zero": 0} | {w: k for k, w in enumerate(UNITS, 1)}).items() for x in kv))
    return F.coalesce(F.expr("try_cast(null as int)"), F.try_element_at(table, F.lower(c)), F.when(c.rlike(r"^\d{1,6}$"), c.cast("int")))


# How totals are announced, in the order in which they are sought.
TOTALS = (
    rf"(?i)\bby\s+{COUNT}\s+(?:votes?\s+)?(?:in\s+favour\s+)?to\s+{COUNT}\b(?:\s+against)?(?:,?\s+with\s+{COUNT}\s+abstentions?)?",
    rf"(?i)\b{COUNT}\s+(?:votes?\s+)?in\s+favour,?\s+to\s+{COUNT}\s+against(?:,?\s+with\s+{COUNT}\s+abstentions?)?",
    rf"(?i)\b{COUNT}\s+votes?\s+in\s+favour,?\s+{COUNT}\s+against(?:,?\s*(?:and\s*)?{COUNT}\s+abstentions?)?",
)


def vote_totals(c: Column) -> Column:
    """Yes, no and abstentions of the first form that fits; no abstentions where none are named, all null where nothing is counted."""
    found = F.coalesce(*(F.when(c.rlike(p), F.array(*(F.regexp_extract(c, p, k) for k in (1, 2, 3)))) for p in TOTALS))
    n = let(found, lambda x: F.transform(x, vote_count))
    return let(n, lambda x: F.struct(F.get(x, F.lit(0)).alias("yes"), F.get(x, F.lit(1)).alias("no"), F.when(F.get(x, F.lit(0)).isNotNull(), F.coalesce(F.get(x, F.lit(2)), F.lit(0))).alias("abstain")))


# Headings of the lists of states, and what ends a list.
POSITIONS = {"yes": r"In\s+favour", "no": "Against", "abstain": "Abstaining"}
LIST_END = r"\n\s*(?:In\s+favour|Against|Abstaining|Draft\s+res|The\s+draft|The\s+amend|was\s+adopted|\[)"
LIST_HEADING = rf"(?:{'|'.join(POSITIONS.values())})\s*:"


def country_votes(c: Column) -> Column:
    """(country, position) of each state in the lists `In favour:`, `Against:` and `Abstaining:` of a text. Lists stand before the adoption or after it; if there are some before, those after it belong to another vote. A state counts once, with its first position."""
    before, after = F.regexp_extract(c, r"(?is)^(.*?)was\s+adopted", 1), F.regexp_extract(c, r"(?is)was\s+adopted(.*)$", 1)
    region = F.when(~c.rlike(r"(?i)was\s+adopted"), c).when(before.rlike(rf"(?i)(?:^|\n)\s*{LIST_HEADING}"), before).otherwise(after)

    def listed(text: Column, position: str, heading: str) -> Column:
        names = country_list(extracted(text, rf"(?is)(?:^|\n)\s*{heading}\s*:\s*(.*?)(?={LIST_END}|$(?!\n))", 1))
        return F.transform(names, lambda x: F.struct(x.alias("country"), F.lit(position).alias("position")))

    every = let(region, lambda r: F.concat(*(listed(r, *x) for x in POSITIONS.items())))
    names = lambda votes: F.transform(votes, lambda v: F.lower(v["country"]))
    once = let(every, lambda e: let(names(e), lambda n: F.filter(e, lambda v, i: F.array_position(n, F.lower(v["country"])) == i + 1)))
    return F.coalesce(once, F.array().cast("array<struct<country:string,position:string>>"))


def repair_draft_symbol(c: Column) -> Column:
    """What scans make of draft symbols: `C.I` is C.1, `L,` is L., J between figures is 1; noise at the end goes."""
    s = F.regexp_replace(c, r"\bC\.I\b", "C.1")
    s = F.regexp_replace(s, r"\bL,", "L.")
    s = F.regexp_replace(s, r"(?<=[\d./])J(?=[\d/]|$)", "1")
    return F.regexp_replace(F.trim(s), r"[\s.,;:)]+$", "")


ROMAN = "[IVXLCDM]+(?: [A-Z])?"


def adoption(c: Column) -> Column:
    """The draft that a line says was adopted (null if it doesn't name it) and the number it got; both null where nothing was adopted. Six forms: `Draft resolution A/64/L.72 was adopted (resolution 64/299)`, a Roman numeral instead, an amendment, `The draft decision was adopted`, `Draft resolution was adopted by 113 votes ... (resolution 75/1)`, `The draft resolution has been adopted as resolution 2448 (2018)`."""
    draft = extracted(c, rf"(?i:draft\s+(?:resolution|decision)|the\s+amendment)\s+\(?((?i:[AS]/[^\s()]+?)|{ROMAN})\)?(?:,\s*as\s+orally\s+corrected,)?\s+(?i:was\s+adopted)")
    number = F.coalesce(extracted(c, r"(?is)was\s+adopted.*?\((?:resolution|decision)\s+([^\s()]+(?:\s\(\d{4}\))?)\)"), extracted(c, r"(?i)has\s+been\s+adopted\s+as\s+(?:resolution|decision)\s+(\d+\s*\(\d{4}\))"))
    return F.struct(repair_draft_symbol(draft).alias("draft"), F.when(is_adoption(c), number).alias("adopted"))


def is_adoption(c: Column) -> Column:
    """Whether a draft or an amendment was adopted."""
    return c.rlike(rf"(?i:draft\s+(?:resolution|decision))(?:\s+(?:(?i:[AS]/\S+)|{ROMAN})(?:,\s*as\s+orally\s+corrected,)?)?\s+(?i:was\s+adopted|has\s+been\s+adopted)|(?i:the\s+amendment\s+\(\S+\)\s+was\s+adopted)")


QUOTED = r"entitled\s+[\"'“‘](.+?)[\"'“‘”’]"


def entitled(c: Column, symbol: Column | None = None) -> Column:
    """The title in quotation marks that is announced for the draft `symbol`, whose end may stand alone; without one, the last title."""
    last = F.try_element_at(F.regexp_extract_all(c, F.lit(rf"(?is){QUOTED}"), F.lit(1)), F.lit(-1))
    if symbol is None:
        return F.trim(last)
    p = rf"(?is)draft\s+(?:resolution|decision)\s+(\S+?),?\s+(?:is\s+)?{QUOTED}"
    found = F.arrays_zip(F.regexp_extract_all(c, F.lit(p), F.lit(1)).alias("symbol"), F.regexp_extract_all(c, F.lit(p), F.lit(2)).alias("title"))
    own = F.upper(symbol)
    same = F.filter(found, lambda x: F.upper(x["symbol"]).endswith(own) | own.endswith(F.upper(x["symbol"])))
    return F.trim(F.coalesce(F.try_element_at(same, F.lit(1))["title"], last))


# What stage directions say, in the order in which they are sought.
DIRECTIONS = {
    "adoption": r"(?i)draft\s+(?:resolution|decision)\b.*was\s+adopted|the\s+amendment\s+\([^)]+\)\s+was\s+adopted",
    "decision": r"It was so decided|(?i:the\s+decision\s+was\s+adopted)",
    "suspension": r"(?i)meeting\s+was\s+suspended",
    "resumption": r"(?i)meeting\s+(?:was\s+)?resumed",
    "adjournment": r"(?i)meeting\s+rose",
    "silence": r"(?i)minute\s+of\s+silence",
    "language_note": r"(?i)^\s*\(spoke\s+in\s+\w+\)\s*$",
}


def stage_direction(c: Column) -> Column:
    """Eight kinds, the first that fits."""
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for k, p in DIRECTIONS.items():
        out = out.when(c.rlike(p), k)
    return out.otherwise("other")


MENTIONS = (
    (r"(?i)\b(A/RES/\d+/\d+[A-Z]?)", ""),
    (r"(?i)\b(S/RES/\d+)\b", ""),
    (r"(?i)\b((?:A/(?:C\.\d/)?\d+|S/\d{4})/(?:L\.)?\d+(?:/REV\.\d+)?)\b", ""),
    (r"(?i)\bresolution (\d+/\d+)\b", "A/RES/"),
    (r"(?i)\bresolution (\d{3,4})(?: \(\d{4}\))?(?![\d/])", "S/RES/"),
)


def mentions(c: Column) -> Column:
    """The distinct symbols in a text in capitals; council numbers have three figures at least."""

    def each(pattern: str, before: str) -> Column:
        return F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), lambda m: F.concat(F.lit(before), F.upper(m)))

    found = [each(p, before) for p, before in MENTIONS]
    return F.array_sort(F.array_distinct(F.concat(*found)))


def sentences(c: Column) -> Column:
    """T30."""
    return F.split(c, r"(?<=[.!?])\s+")


def cosponsors(sentence: Column) -> Column:
    """The names after `co-sponsors`, unless the sentence withdraws them."""
    listed = extracted(sentence, r"(?i)co-?\s?sponsors?(?:hip)?(?: of [A-Z0-9./]+)?(?: are| were|:| by|, namely,?) (.+?)[.;]?$")
    return F.when(sentence.rlike(r"(?i)\b(?:not|withdr[ae]w|no longer)\b"), F.array().cast("array<string>")).otherwise(F.coalesce(sponsor_list(listed), F.array().cast("array<string>")))


# What is sponsored but is no draft, and the form of symbols.
NO_DRAFT = r"(?i)co[- ]?sponsor\s+of\s+(?:the\s+)?(?:peace\s+process|initiative|efforts?|talks?|negotiations?|meeting|conference|summit)\b"
SYMBOL = r"[A-Z][A-Z0-9/.\-]*[A-Z0-9]"


def sponsorship(sentence: Column) -> Column:
    """What a sentence says of co-sponsoring: kind `list` (states and a draft), `symbol` or `parenthesis` (the speaker sponsors this draft), `implicit` (the draft isn't named: that of the item, if it has one only), with symbol and countries; null where it says nothing of it."""
    said = rf"(?i)following\s+(?:\w+\s+)?(?:countries|delegations|states|members)\s+(?:are\s+now|also\s+become|have\s+become|are|were)?\s*co[- ]?sponsors?\s+of\s+(?:draft\s+)?resolution\s+({SYMBOL})\s*[:\-]?\s*(.+?)[.;]?$"
    named = rf"(?i)co[- ]?sponsor(?:s|ed|ing)?\b(?:\s+\w+){{0,6}}?\s+(?:draft\s+)?resolution\s+({SYMBOL})"
    bracketed = rf"(?i)co[- ]?sponsor(?:s|ed|ing)?\b.{{0,120}}?\(({SYMBOL})\)"
    a, b, c = (extracted(sentence, p, 1) for p in (said, named, bracketed))
    kind = F.when(a.isNotNull(), "list").when(b.contains("/"), "symbol").when(c.contains("/"), "parenthesis").otherwise("implicit")
    states = F.when(a.isNotNull(), sponsor_list(extracted(sentence, said, 2))).otherwise(F.array().cast("array<string>"))
    symbol = F.upper(F.coalesce(a, F.when(b.contains("/"), b), F.when(c.contains("/"), c)))
    return F.when(sentence.rlike(r"(?i)\bco[- ]?sponsor") & ~sentence.rlike(NO_DRAFT), F.struct(kind.alias("kind"), symbol.alias("symbol"), states.alias("countries")))


def speaker_info(c: Column) -> Column:
    """Title, name, country or organization, language and role of `Mr. Dai Bing (China) (spoke in Chinese):`; null if it labels nobody."""
    label = r"^\s*(?:\d+\.\s*)?((?i:Mr|Mrs|Ms|Miss|Dr|Sir|Dame|Prof)\.?)\s+([^(:\[]+?)\s*(?:\(([^)]*)\))?\s*(?:\((?i:spoke in) ([^)]*)\))?\s*[:;]?\s*$"
    office = r"(?i)^\s*(the (?:acting |vice-)?(?:president|chair(?:man|person)?|secretary-general))\s*(?:\(spoke in ([^)]*)\))?\s*[:;]?\s*$"
    spoke = extracted(c, r"(?i)\(spoke in ([^)]*)\)")
    place = extracted(c, label, 3)
    named = F.struct(F.trim(extracted(c, label, 1)).alias("title"), normalize_allcaps(F.trim(extracted(c, label, 2))).alias("name"), F.when(place.rlike("(?i)^spoke in "), F.lit(None)).otherwise(place).alias("country"), spoke.alias("language"), F.lit(None).cast("string").alias("role"))
    role = F.regexp_replace(F.regexp_replace(extracted(c, office, 1), "(?i)^the ", ""), r"\s+", " ")
    presiding = F.struct(F.lit(None).cast("string").alias("title"), F.trim(extracted(c, office, 1)).alias("name"), F.lit(None).cast("string").alias("country"), spoke.alias("language"), role.alias("role"))
    return F.when(extracted(c, office, 1).isNotNull(), presiding).when(extracted(c, label, 2).isNotNull(), named)


# Fixed value: how a group is named.
ON_BEHALF = r"(?i)on\s+behalf\s+of\s+(?:the\s+)?([\p{L}\p{N}_\s,\-]+?)(?:\s*[.,;]|\s+I\b)"


def on_behalf_of(c: Column) -> Column:
    """Whom the first 500 characters speak for, without the article."""
    return F.trim(extracted(F.substring(c, 1, 500), ON_BEHALF))


def agenda_header(c: Column) -> Column:
    """Number, sub-item, whether continued, and title."""
    p = r"(?i)^\s*agenda items?\s+(\d+)(?:\s*\(([a-z])\))?\s*(\(continued\))?\s*[-–—.:]?\s*(.*)$"
    title = F.trim(F.regexp_replace(F.regexp_extract(c, p, 4), r"(?i)\(continued\)", ""))
    return F.struct(extracted(c, p, 1).cast("int").alias("agenda_number"), extracted(c, p, 2).alias("sub_item"), c.rlike(r"(?i)\(continued\)").alias("continued"), F.nullif(title, F.lit("")).alias("title"))


def split_attribution(c: Column) -> Column:
    """What stands before the colon that ends a label, or before an early semicolon; the number of the paragraph goes."""
    s = F.regexp_replace(c, r"^\s*\d+\.\s*", "")
    p = r"(?s)^((?:(?i:Mr|Mrs|Ms|Miss|Dr|Sir|The)\b)[^:;]{1,99})[:;]\s*(.*)$"
    return F.struct(F.trim(extracted(s, p, 1)).alias("attribution"), F.when(extracted(s, p, 1).isNotNull(), F.regexp_extract(s, p, 2)).otherwise(s).alias("body"))


ORGANIZATION = r"(?i)\b(?:union|organi[sz]ation|league|council|committee|agency|office|secretariat|federation|bureau|bank|fund|court|order|group|department|commission|programme)\b"


def is_organization(c: Column) -> Column:
    """P16, for names that no list of states has."""
    return F.coalesce(c.rlike(ORGANIZATION) | c.rlike(r"^[A-Z]{3,6}$"), F.lit(False))


JUNK = ("n/a", "none", "unknown", "-", "?", "tbd", "various")


def junk_flags(c: Column) -> Column:
    """Why a name may be none."""
    s = F.trim(c)
    return F.array_compact(F.array(F.when(s.isNull() | (F.length(s) < 3), "short"), F.when(~s.rlike(r"^\p{L}"), "starts_non_letter"), F.when(s.rlike(r"\d"), "has_digit"), F.when(F.length(s) > 100, "long"), F.when(F.lower(s).isin(*JUNK), "sentinel")))


def topic_text(c: Column) -> Column:
    """Lower case, letters only."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z]+", " "))


def file_key(c: Column) -> Column:
    """T40."""
    return F.translate(c, "/", "_")


def bool_of(c: Column) -> Column:
    """Three values."""
    return F.when(F.lower(c) == "true", True).when(F.lower(c) == "false", False)


def string_list(c: Column) -> Column:
    """A JSON array, a list written with single quotes, or one value."""
    listed = F.from_json(F.translate(c, "'", '"'), "array<string>")
    return F.when(c.rlike(r"^\s*\["), listed).when(c.isNotNull(), F.array(F.trim(c)))


# How a cover names the one who presides, with dots up to the state or without.
PRESIDENT = (r"(?s)President\s*:\s*(.+?)\s*[.\s]{3,}\s*\(([^)]+)\)", r"(?s)President\s*:\s*(.+?)\s*\(([^)]+)\)")


def president(c: Column) -> Column:
    """Name and country of the one who presides, without the dots between them; null if the cover names nobody."""
    found = F.coalesce(*(F.when(c.rlike(p), F.array(*(F.regexp_extract(c, p, k) for k in (1, 2)))) for p in PRESIDENT))
    name = lambda x: normalize_allcaps(F.regexp_replace(F.trim(F.get(x, F.lit(0))), r"[\s._\-]+$", ""))
    return let(found, lambda x: F.when(x.isNotNull(), F.struct(name(x).alias("name"), F.trim(F.get(x, F.lit(1))).alias("country"))))


def record_metadata(cover: Column) -> Column:
    """Symbol, session, meeting number, date, location, president and body that the text of a cover gives; a council's session is its year, spelt out. Without a symbol the body is the assembly."""
    symbol = record_symbol(cover)
    session = F.when(symbol.startswith("A/"), session_of(symbol)).otherwise(ordinal_year(cover))
    return F.struct(symbol.alias("symbol"), session.alias("session"), meeting_number(cover).alias("meeting_number"), spelled_date(cover).alias("date"), location(cover).alias("location"), president(cover).alias("president"), F.coalesce(body_of(symbol), F.lit("GA")).alias("body"))


def metadata_ladder(*steps: Column) -> Column:
    """Field by field the first step that gives it: what the cover's text says, what cover and path say together, what the path says. Steps are as of record_metadata; the body follows the symbol that is found."""
    fields = ("symbol", "session", "meeting_number", "date", "location", "president")
    first = {f: F.coalesce(*(s[f] for s in steps)) for f in fields}
    return F.struct(*(c.alias(f) for f, c in first.items()), F.coalesce(body_of(first["symbol"]), F.lit("GA")).alias("body"))


def speech_text(blocks: Column) -> Column:
    """The text of a speech from its blocks, the first of which bears the label: blocks that aren't blank in paragraphs, without print codes, divided words joined."""
    first = F.array(split_attribution(F.get(blocks, F.lit(0)))["body"])
    parts = F.filter(F.transform(F.concat(first, F.slice(blocks, 2, 1_000_000)), lambda b: F.trim(b)), lambda b: b != "")
    return repair_hyphenation(strip_print_codes(F.array_join(parts, "\n\n")))


def vote_errors(vote_type: Column, totals: Column, votes: Column) -> Column:
    """What a recorded vote lacks: counts, or the list of states."""
    recorded = vote_type == "recorded"
    counts = [F.when(recorded & totals[n].isNull(), f"{n}: missing") for n in ("yes", "no", "abstain")]
    return F.array_compact(F.array(*counts, F.when(recorded & (F.coalesce(F.size(votes), F.lit(0)) == 0), "votes: empty")))


def year_of_symbol(c: Column) -> Column:
    """The year in a council's document symbol."""
    return extracted(c, r"^S/([12][0-9]{3})/").cast("int")
