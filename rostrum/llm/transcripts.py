"""Speech transcripts into clean speaker turns: a parsing-expression grammar of labels, times and nested annotations."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import Registry
from ..tables import load
from .peg import alt, find, many, opt, rx, seq, text_of
from .strings import unaccent, within

query = Registry()

# Titles, offices, name particles, fillers and sounds of transcripts.
TITLES = r"(?:Mr|Mrs|Ms|Miss|Dr|Sir|Dame|Prof|Madam|Mme|M)"
OFFICES = r"(?:Acting President|Vice-President|President|Chairperson|Chairman|Chair|Secretary-General|Secretary|Speaker|Moderator)"
PARTICLES = r"(?:van|von|de|da|di|del|der|den|la|le|el|al|bin|ibn|st)"
FILLERS = r"(?:u+h+|u+m+|e+r+m*|a+h+|e+h+|h+m+|mm+)(?:\.\.\.|…|,|\s+[—–-](?=\s))?|(?:you know|I mean),"

#: Brackets of annotations.
CLOSES = {"[": "]", "(": ")", "{": "}", "<": ">"}


@lru_cache(maxsize=64)
def brackets(s: str) -> dict[int, int]:
    """Where the annotation ends that opens at a place. Annotations nest within a line, to any depth, and aren't empty; a bracket that doesn't close, or holds one that doesn't, is ordinary text."""
    out: dict[int, int] = {}
    open_: list[int] = []
    for i, c in enumerate(s):
        if c in "[({<":
            open_.append(i)
        elif c == "\n":
            open_.clear()
        elif c in "])}>":
            if open_ and CLOSES[s[open_[-1]]] == c and i > open_[-1] + 1:
                out[open_.pop()] = i + 1
            else:
                open_.clear()
    return out


def nested(s: str, i: int):
    """A whole annotation in brackets."""
    return (("sound", s[i:end]), end) if s[i : i + 1] in CLOSES and (end := brackets(s).get(i)) is not None else None


# Grammar. Annotations nest; a bracket that never closes is ordinary text.
annotation = alt(nested, rx(r"\*[^*\n]{1,60}\*|♪", "sound"))
space = rx(r"[ \t\xa0]*")
clock = alt(rx(r"\d{1,3}:[0-5]\d(?::[0-5]\d)?(?:[.,]\d{1,3})?(?!\d)", "clock"), rx(r"T?\+?\d+(?:\.\d+)?\s?s(?:ec)?\b", "clock"))
time = seq(alt(seq(rx(r"[\[(<]"), space, clock, space, rx(r"[\])>]")), clock), opt(rx(r"[ \t]*\|")))
arrow = seq(clock, space, rx(r"-->"), space, rx(r"[\d:.,]+"), space, name="cue")
title = rx(rf"{TITLES}\b\.?[ \xa0]+", "title", re.IGNORECASE)
office = rx(rf"(?:(?:The|Madam|Mr\.?)[ \xa0]+)?{OFFICES}(?![\w'’-])", "office", re.IGNORECASE)
word = rx(rf"(?:{PARTICLES}\b[ \xa0]+)*(?:[A-Z]\.)*(?:[^\W\d_a-z]|(?<![^\W_])0)[\w'’.\-]*", "word")
name = seq(word, many(seq(rx(r"[ \xa0]+"), word)), name="name")
place = rx(r"\((?![^()]*\d:\d)[^()\n]{2,80}\)|\[[A-Z]{2,4}\]", "place")
tail = many(seq(space, alt(place, rx(r"\(spoke in [^()]*\)", flags=re.IGNORECASE))), name="tail")
label = seq(alt(office, seq(opt(title), name)), tail, opt(seq(space, time, name="at")), name="label")
mark = alt(rx(r"[ \xa0]*[:;](?=\s|$)"), rx(r"[ \t]*\|(?=\s|$)"), rx(r"[ \xa0]+[-–—](?=\s|$)"), rx(r"\.[-–—](?=\s|$)"))
sounds = many(seq(space, annotation, space))
end = rx(r"[ \t\xa0]*$")
# A line: a cue or time, a label with its mark, and what is said. A label without mark must fill its line.
head = seq(opt(alt(arrow, seq(time, space))), sounds, opt(seq(label, mark, space, name="speaker")), name="head")
alone = seq(label, end, name="alone")
time_alone = seq(alt(arrow, time), end, name="time")
number_alone = rx(r"\d{1,6}[ \t]*$", "number")
# Labels within running text: a title with name and place, or an office.
inline = seq(alt(office, seq(title, name, tail)), tail, rx(r"[ \xa0]*:(?=\s)"), name="speaker")
INLINE_AT = re.compile(rf"(?:^|(?<=[.!?»\"\])}}>*♪…—,])|(?<=[.!?]\s))\s*(?=(?:{TITLES}\b|(?:The[ \xa0]+)?{OFFICES}\b)[^:\n]{{0,120}}:\s)", re.IGNORECASE)

SOME_LABEL = re.compile(rf"\b(?:{TITLES}\b|{OFFICES}\b)|\d:\d\d|\d\s?s?\s?\||^[^\s:;]+(?: [^\s:;]+){{0,4}}(?:[:;]| [-–—]) ", re.IGNORECASE | re.MULTILINE)
FILLER = re.compile(rf"(?<![\w'])(?:{FILLERS})(?![\w'])[ \t]*", re.IGNORECASE)
TWICE = re.compile(r"\b(\w+)(?:\s+\1\b)+", re.IGNORECASE)


def seconds(clock_text: str) -> float:
    parts = clock_text.replace(",", ".").strip("T+sec ").split(":")
    return sum(float(p) * 60**k for k, p in enumerate(reversed(parts)))


@dataclass
class Said:
    """An utterance: its label (None: the speaker goes on), its time if the line bears one, and its words."""

    label: Label | None
    at: float | None
    text: str


@dataclass
class Label:
    office: str = ""
    title: str = ""
    words: tuple[str, ...] = ()
    place: str = ""

    @classmethod
    def of(cls, node) -> Label:
        places = [text_of(x)[1:-1] for x in _all(node, "place")]
        p = next((x for x in places if not x.lower().startswith("spoke")), "")
        if (o := find(node, "office")) is not None:
            return cls(office=re.sub(r"^(?:the|madam|mr\.?)\s+", "", unaccent(text_of(o)).lower()), place=p.lower())
        return cls("", text_of(find(node, "title")).strip(" .\xa0").lower(), name_words(text_of(find(node, "name"))), unaccent(p).lower())


def _all(node, name_: str) -> list:
    if node[0] == name_:
        return [node]
    return [x for c in node[1] for x in _all(c, name_)] if isinstance(node[1], list) else []


def name_words(s: str) -> tuple[str, ...]:
    """The words of a name without accents and case; scan digits that stand for letters are letters."""
    s = unaccent(s).lower().replace("0", "o").replace("1", "l")
    return tuple(w.strip(".'-") for w in re.split(r"[\s,]+", s) if w.strip(".'-"))


def parse_lines(text: str) -> list[Said]:
    """What the lines of a transcript say. Lines that bear only a label, a time, a cue or a number belong to the line after them."""
    out: list[Said] = []
    label_, at = None, None
    lines = [x for line in text.split("\n") if (x := line.strip())]
    for k, line in enumerate(lines):
        if (r := time_alone(line, 0)) is not None:
            at = seconds(text_of(find(r[0], "clock")))
            continue
        if number_alone(line, 0) is not None:
            continue
        follows = k + 1 < len(lines) and time_alone(lines[k + 1], 0) is not None
        if follows and (r := alone(line, 0)) is not None and plausible(r[0]):
            label_ = Label.of(r[0])
            if (c := find(r[0], "clock")) is not None:
                at = seconds(text_of(c))
            continue
        node, i = head(line, 0)
        if (s := find(node, "speaker")) is not None:
            if plausible(s):
                label_ = Label.of(s)
            else:  # a colon in a sentence: give its words back
                i -= len(text_of(s))
        if (c := find(node, "clock")) is not None:
            at = seconds(text_of(c))
        out.append(Said(label_, at, line[i:]))
        label_, at = None, None
    if label_ is not None:
        out.append(Said(label_, at, ""))
    return out


# Words of running headers, which are no names.
HEADER_WORDS = frozenset(("security", "council", "general", "assembly", "official", "records", "provisional", "verbatim", "record", "plenary", "meeting", "page"))


def plausible(node) -> bool:
    """Whether what looks like a label may be one. Words of a sentence before a colon may begin with a capital too, but lack a title; numbers and words of headers are no names."""
    if find(node, "office") is not None:
        return True
    words = [text_of(w) for w in _all(node, "word")]
    if len(words) > 5:
        return False
    return find(node, "title") is not None or not any(re.search(r"\d\d|\.\w", w) or w.lower() in HEADER_WORDS for w in words)


def parse_inline(text: str) -> list[Said]:
    """What is said in running text whose labels stand within it."""
    out: list[Said] = []
    done, current = 0, None
    for m in INLINE_AT.finditer(text):
        if m.end() < done:
            continue
        r = inline(text, m.end())
        if r is None:
            continue
        if (before := text[done : m.start()]).strip() or current is not None:
            out.append(Said(current, None, before))
        current, done = Label.of(r[0]), r[1]
    if current is not None:
        out.append(Said(current, None, text[done:]))
    return out


def utterances(text: str) -> list[Said]:
    """The utterances of a text in the order of speaking: of lines that bear times, by these (equal times keep their order); lines without a time stay behind the one before them."""
    lines = parse_lines(text)
    running = parse_inline(text)
    labels = sum(s.label is not None for s in lines)
    if sum(s.label is not None for s in running) > labels:
        return running
    last, keyed = float("-inf"), []
    for k, s in enumerate(lines):
        last = s.at if s.at is not None else last
        keyed.append((last, k, s))
    # a line without label goes on with the speaker before it in time
    return [s for _, _, s in sorted(keyed, key=lambda x: x[:2])]


MAY_OPEN = re.compile(r"[\[({<*♪]")


def clean(text: str) -> str:
    """Without sounds, fillers and words said twice."""
    out, at, i = [], 0, 0
    while (m := MAY_OPEN.search(text, i)) is not None:
        i = m.start()
        if (r := annotation(text, i)) is not None and not re.search(r"\d:\d", text_of(r[0])):
            out.append(text[at:i])
            at = i = r[1]
        else:
            i += 1
    out.append(text[at:])
    return re.sub(r"\s+", " ", TWICE.sub(r"\1", FILLER.sub("", "".join(out)))).strip()


GENDER = {"mr": "m", "sir": "m", "m": "m", "mrs": "f", "ms": "f", "miss": "f", "dame": "f", "mme": "f", "madam": "f"}


def same_word(a: str, b: str) -> bool:
    if a == b:
        return True
    n = min(len(a), len(b))
    return n >= 3 and within(a, b, 0 if n == 3 and len(a) == len(b) else 1 if n < 8 else 2) is not None


def _alike(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """Whether the shorter name ends the longer one, word for word."""
    n = min(len(a), len(b))
    return n > 0 and all(same_word(x, y) for x, y in zip(a[-n:], b[-n:]))


@dataclass
class Speaker:
    words: tuple[str, ...] = ()
    spellings: list[tuple[str, ...]] = field(default_factory=list)
    offices: set[str] = field(default_factory=set)
    places: set[str] = field(default_factory=set)
    genders: set[str] = field(default_factory=set)

    def fits(self, label_: Label) -> int:
        """0 if the label can't mean this speaker; more for the better fit."""
        if label_.office:
            return 4 if label_.office in self.offices else 0
        exact = [x[-min(len(x), len(label_.words)) :] == label_.words[-min(len(x), len(label_.words)) :] for x in self.spellings if _alike(x, label_.words)]
        if not exact:
            return 0
        g = GENDER.get(label_.title)
        if g and self.genders and g not in self.genders:
            return 0
        named = {p for p in self.places if len(p) > 4}
        if len(label_.place) > 4 and named and not any(within(label_.place, p, 2) is not None or p in label_.place or label_.place in p for p in named):
            return 0
        codes = {p for p in self.places if len(p) <= 4}
        if 0 < len(label_.place) <= 4 and codes and label_.place not in codes:
            return 0
        return 2 + any(exact)

    def add(self, label_: Label) -> None:
        if label_.office:
            self.offices.add(label_.office)
        if label_.words and label_.words not in self.spellings:
            self.spellings.append(label_.words)
        if len(label_.words) > len(self.words):
            self.words = label_.words
        if label_.place:
            self.places.add(label_.place)
        if g := GENDER.get(label_.title):
            self.genders.add(g)


def turns(text: str | None, name_: str | None = None, role: str | None = None) -> list[tuple[int, str, str]]:
    """(speaker_no, speaker, words) of each turn in order; empty where the text doesn't hold the labelled words of two speakers or more.

    What stands before the first label is the first speaker's only if nothing else speaks for another; it is left out. name_ and role are those of the row: where the role is President, the label of that office means the person of that name.
    """
    if not text or not SOME_LABEL.search(text):
        return []
    said = utterances(text)
    if sum(s.label is not None for s in said) < 2:
        return []
    main = name_words(re.sub(rf"-\s+|^\W*(?:H\.\s?E\.\s*)?(?:{TITLES}\b\.?)?", "", name_ or "", flags=re.IGNORECASE))
    main_is_office = bool(re.fullmatch(rf"(?:the\s+)?{OFFICES}", (name_ or "").strip(), re.IGNORECASE))
    presides = (role or "").strip().lower() == "president" and not main_is_office
    speakers: list[Speaker] = []
    president: int | None = None

    # of a name also neighbouring words as one, where a space tears it
    joined = [*main, *(a + b for a, b in zip(main, main[1:]))]

    def means_main(label_: Label) -> bool:
        if not label_.words or not main or not any(same_word(label_.words[-1], w) for w in joined if len(w) > 2):
            return False
        given = label_.words[:-1]
        return len(main) == 1 or all(any(same_word(g, w) or (len(w) == 1 and g[0] == w) for w in joined) for g in given)

    who: list[int | None] = []
    current: int | None = None
    for s in said:
        if s.label is not None:
            fit = [(sp.fits(s.label), -k) for k, sp in enumerate(speakers)]
            best = max(fit, default=(0, 0))
            if best[0] > 0:
                current = -best[1]
            else:
                current = None
                if presides:
                    if s.label.office == "president" or means_main(s.label):
                        if president is None:
                            speakers.append(Speaker())
                            president = len(speakers) - 1
                        current = president
                if current is None:
                    speakers.append(Speaker())
                    current = len(speakers) - 1
            speakers[current].add(s.label)
            if presides and president is None and (s.label.office == "president" or means_main(s.label)):
                president = current
        who.append(current)
    order: dict[int, int] = {}
    out: list[tuple[int, str, list[str]]] = []
    for s, k in zip(said, who):
        if k is None:
            continue
        no = order.setdefault(k, len(order) + 1)
        if out and out[-1][0] == no:
            out[-1][2].append(s.text)
        else:
            sp = speakers[k]
            out.append((no, " ".join(sp.words) or next(iter(sorted(sp.offices)), ""), [s.text]))
    if len(order) < 2:
        return []
    return [(no, speaker, clean("\n".join(x))) for no, speaker, x in out]


def speaker_turns(speeches: DataFrame, key: str = "id", text: str = "text", name: str = "name", role: str = "role") -> DataFrame:
    """speech_id, turn_no, speaker_no, speaker, words of all transcripts among the rows. Each row is read by itself, without a shuffle. Null and empty texts, and texts of one speaker, have no turns; repeated rows each get theirs."""
    kind = speeches.schema[key].dataType.simpleString()
    rows = speeches.select(F.col(key).alias("speech_id"), F.col(text).alias("text"), F.col(name).alias("name"), F.col(role).alias("role"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(i, k, no, s, w) for i, t, n, r in b.itertuples(index=False, name=None) for k, (no, s, w) in enumerate(turns(t, n, r), 1)]
            yield pd.DataFrame(out, columns=["speech_id", "turn_no", "speaker_no", "speaker", "words"])

    return rows.where(F.col("text").rlike(r"[:;|]|\s[-–—]\s|\d:\d\d")).mapInPandas(run, f"speech_id {kind}, turn_no int, speaker_no int, speaker string, words string")


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    s = load(spark, sf, "speeches").select("id", "text", "speaker.name", "speaker.role")
    return speaker_turns(s)


@query("p4_found")
def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """The turns of all transcripts with the number of their speaker."""
    return _turns(spark, sf).select("speech_id", "turn_no", "speaker_no").distinct()


@query("p4_turns")
def p4_turns(spark: SparkSession, sf: str) -> DataFrame:
    """The clean turns themselves."""
    return _turns(spark, sf)
