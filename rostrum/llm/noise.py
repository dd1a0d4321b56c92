"""Noise in text from scanned pages: divided words, misread characters, running headers and page numbers.

A noisy channel: the probability that the scan turned a word into what stands there (character confusions) times the likelihood of the words in a row (bigrams of the whole corpus), decoded by Viterbi over the candidates of each word of a line.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import Registry
from ..runtime import cut
from ..tables import load
from .transcripts import turns

query = Registry()

# What scans may take characters for (read: the true characters). How likely each is is learned from the corpus.
CONFUSIONS = {"1": "li", "0": "o", "5": "s", "9": "g", "6": "b", "8": "b", "3": "e", "!": "il", "|": "li", "†": "t", "ɑ": "a", "í": "i", "ì": "i", "ı": "i", "rn": "m", "nn": "m", "m": ("rn",), "ii": "u", "vv": "w", "cl": "d", "c": "e", "e": "c", "b": "h", "h": "b", "li": ("h",), "ﬁ": ("fi",), "ﬂ": ("fl",), "$": "s", "@": "a", "£": "e"}
#: Signs that no clean word holds.
SIGNS = frozenset("0123456789!|†ɑíìıﬁﬂ$@£")
#: How many places of a word may be misread before it is no longer sought; of how many characters one is misread before the corpus is seen, and for how many observations that stands.
PLACES, MISREAD, PRIOR = 3, 1 / 500, 200
#: How many times more often than the word that stands there a candidate must be found in the corpus, and how often at least.
TIMES, LEAST = 20, 3
DOUBT = "\0"
#: Words and pairs of words with a smaller share of the corpus count as unknown; so the tables that every task holds have fewer than 1 / RARE entries each, of 12 bytes.
RARE = 1 / (1 << 23)
#: A line is a running header or a page number if its form stands in so many texts and in this share of all short lines (so there are at most 1 / LINE_SHARE forms), if the words before it and after it differ (no one has more than SAME of them), and it interrupts a sentence in INTERRUPTS of the cases.
LINE_TEXTS, LINE_SHARE, SAME, INTERRUPTS = 3, 1 / 100_000, 0.34, 0.2
#: Longer lines are no headers.
LINE_CHARS = 80
#: Forms with fewer letters are page numbers.
HEADER_LETTERS = 5

# What is written in place of letters in headers, and months.
DIGITS_IN_WORDS = str.maketrans("05193!†ɑ", "osigeita")
MONTH = re.compile(r"\b(?:january|february|march|april|may|june|july|august|september|october|november|december)\b")
MIXED = re.compile(r"(?<![^\s])(?=\S*[^\W\d_])(?=\S*[05193!†ɑ])[^\s/]+(?![^\s])")
ORDINAL = re.compile(r"\d+(?:st|nd|rd|th)")

BEFORE, AFTER = re.compile(r"[^\W\d_][^\s\-\xad¬]*\Z"), re.compile(r"[^\W\d_][^\s\-\xad¬]*")
DIVIDES = re.compile(r"(?<=\S)(?:-\s+|[\xad¬]\s*)")
TOKEN = re.compile(r"\S+")
AROUND = ".,;:()[]{}\"'“”‘’«»*?…"


def core(token: str) -> str:
    """The token in lower case without punctuation around it; a sign of exclamation ends a word."""
    return token.lower().strip(AROUND).rstrip("!").strip(AROUND)


class Cores(dict):
    """The cores of tokens, each of which is found once."""

    def __missing__(self, token: str) -> str:
        if len(self) > 1_000_000:
            self.clear()
        self[token] = core(token)
        return self[token]


def line_form(line: str) -> str:
    """A line without what changes from page to page: numbers and months; signs that scans put in place of letters are letters."""
    x = MIXED.sub(lambda m: m[0] if ORDINAL.fullmatch(m[0]) else m[0].translate(DIGITS_IN_WORDS), " ".join(line.lower().split()))
    x = re.sub(r"(?<!\S)5(?=/)", "s", x)
    return re.sub(r"\d+(?:st\b|nd\b|rd\b|th\b)?", "#", MONTH.sub("@", x))


def may_be_header(line: str) -> bool:
    """Short, and not the end of a sentence or clause."""
    return 0 < len(line) <= LINE_CHARS and line[-1] not in ".!?,;:\"”»…"


def key_of(*words: str) -> int:
    """64 bits of a word or a pair of words, as a signed number."""
    return xxhash.xxh64_intdigest(" ".join(words).encode("utf-8", "replace")) - (1 << 63)


class Counts:
    """Counts by key in two sorted arrays."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order].astype(np.float32)

    def of(self, key: int) -> float:
        k = int(np.searchsorted(self.keys, key))
        return float(self.counts[k]) if k < len(self.keys) and self.keys[k] == key else 0.0


class Corpus:
    """Counts of words and of pairs, the channel (natural logarithms of the probabilities of confusions), and the forms of headers and page numbers."""

    def __init__(self, words: Counts, pairs: Counts, total: int, channel: dict[tuple[str, str], float] | None = None, headers: frozenset[str] = frozenset()) -> None:
        self.words, self.pairs, self.total = words, pairs, max(1.0, float(total))
        self.channel, self.headers = channel or {}, headers
        self.cache: dict[str, float] = {}
        self.choices: dict[str, list[tuple[str, float]] | None] = {}
        self.plain: set[str] = set()
        self.cores = Cores()

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}, "choices": {}, "plain": set(), "cores": Cores()}

    def doubtful(self, tokens: list[str]) -> bool:
        """Whether something else may be meant by any of the tokens; those by which nothing else is are kept."""
        out = False
        for t in set(tokens) - self.plain:
            if self.options(self.cores[t]):
                out = True
            else:
                self.plain.add(t)
        if len(self.plain) > 1_000_000:
            self.plain.clear()
        return out

    def count(self, word: str) -> float:
        c = self.cache.get(word)
        if c is None:
            if len(self.cache) > 1_000_000:
                self.cache.clear()
            c = self.cache[word] = self.words.of(key_of(word))
        return c

    def pair(self, a: str, b: str) -> float:
        return self.pairs.of(key_of(a, b))

    def logp(self, a: str, b: str) -> float:
        """Of b after a: bigrams over unigrams over an even distribution of unknown words. Doubtful words, which begin with DOUBT, get the unigram less this find itself, and give no bigram: the corpus holds the text in question too, so a misreading would bear itself out."""
        if b[:1] == DOUBT:
            return math.log((max(0.0, self.count(b[1:]) - 1) + 0.01) / (self.total + 10_000))
        lower = (self.count(b) + 0.01) / (self.total + 10_000)
        return math.log(lower) if a[:1] == DOUBT else math.log((self.pair(a, b) + 5 * lower) / (self.count(a) + 5))

    def confusion(self, seen: str, true: str) -> float:
        return self.channel.get((seen, true), math.log(MISREAD))

    def options(self, word: str) -> list[tuple[str, float]] | None:
        """What may stand there with the logarithms of the channel's probabilities, the word itself (marked as doubtful) first; None if nothing but the word comes into question."""
        if word not in self.choices:
            if len(self.choices) > 1_000_000:
                self.choices.clear()
            out = None
            if may_be_word(word) and (SIGNS & set(word) or self.count(word) * 50 < self.total / 1000) and (found := candidates(word, self)):
                # a sign within a word can't be right, unless nothing else may be meant
                out = [(DOUBT + word, -20.0 if SIGNS & set(word) else len(word) * math.log1p(-MISREAD)), *found]
            self.choices[word] = out
        return self.choices[word]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """kind, key, word, n: of each task the words (0) and pairs (1); of short lines the form with the word before (2) and after (3), and whether it interrupts a sentence (4)."""
    core_of = Cores()
    pairs: Counter[tuple[str, str]] = Counter()
    lines: Counter[tuple[int, str, str]] = Counter()

    def rows() -> pd.DataFrame:
        words: Counter[str] = Counter()
        for (_, b), n in pairs.items():
            words[b] += n
        kinds = np.repeat([0, 1], [len(words), len(pairs)]).tolist() + [k for k, _, _ in lines]
        keys = [key_of(w) for w in words] + [key_of(a, b) for a, b in pairs] + [key_of(x) for _, _, x in lines]
        strings = [*words, *[None] * len(pairs), *(f for _, f, _ in lines)]
        n = [*words.values(), *pairs.values(), *lines.values()]
        pairs.clear()
        lines.clear()
        return pd.DataFrame({"kind": np.array(kinds, dtype=np.int32), "key": np.array(keys, dtype=np.int64), "word": pd.Series(strings, dtype=object), "n": np.array(n, dtype=np.int64)})

    for b in batches:
        for t in b["text"]:
            own = [w for w in map(core_of.__getitem__, t.split()) if w]
            pairs.update(zip(["", *own], own))
            if "\n" in t:
                split = [x for y in t.split("\n") if (x := y.strip())]
                seen, before = set(), ""  # each form once for each text; the line before is the last one of the body
                for x, after in zip(split, split[1:]):
                    if before and may_be_header(x) and (f := line_form(x)) not in seen:
                        seen.add(f)
                        lines[2, f, before.split()[-1]] += 1
                        lines[3, f, after.split()[0]] += 1
                        lines[4, f, "" if may_be_header(before[-1]) and after[0].islower() else "."] += 1
                    if len(x) >= LINE_CHARS // 2 or not before or not may_be_header(x):
                        before = x
            if len(pairs) > 500_000:
                yield rows()
    yield rows()


def learned_headers(lines: DataFrame) -> frozenset[str]:
    """The forms of running headers and page numbers, from lines(kind, key, word, n): forms that recur between changing words, and within sentences."""
    by_form = lines.groupBy("word", "kind").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum(F.when(F.col("key") == key_of(""), F.col("n")).otherwise(0)).alias("open"))
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    forms = cut(by_form.groupBy("word").agg(of(2, "n").alias("n"), of(2, "most").alias("before"), of(3, "most").alias("after"), of(4, "open").alias("open")))
    total = forms.agg(F.sum("n")).first()[0] or 0
    n = F.col("n")
    found = forms.where((n >= LINE_TEXTS) & (n >= total * LINE_SHARE) & (F.col("before") <= F.greatest(n * SAME, F.lit(1))) & (F.col("after") <= F.greatest(n * SAME, F.lit(1))) & (F.col("open") >= n * INTERRUPTS))
    return frozenset(r["word"] for r in found.select("word").collect())


def learned_channel(words: DataFrame, corpus: Corpus) -> dict[tuple[str, str], float]:
    """How likely each confusion is: of the finds of its true characters in the words of the corpus, the share that is read as something else, by the rare words of which a frequent one is made by it. words(word, n) are all distinct words; what comes to the driver is a row for each confusion."""
    sent = words.sparkSession.sparkContext.broadcast(corpus)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, read, there = sent.value, Counter(), Counter()
        targets = {(seen, t) for seen, true in CONFUSIONS.items() for t in true}
        for b in batches:
            for w, n in zip(b["word"], b["n"]):
                for seen, t in targets:
                    if t in w:
                        there[seen, t] += int(n) * w.count(t)
                if may_be_word(w):
                    own = 0 if SIGNS & set(w) else n
                    for x, pair in changed(w):
                        if (m := c.count(x)) >= LEAST and m >= TIMES * own:
                            read[pair] += int(n)
        yield pd.DataFrame([(*p, read[p], there[p]) for p in targets], columns=["seen", "true", "read", "there"])

    rows = words.mapInPandas(run, "seen string, true string, read long, there long").groupBy("seen", "true").agg(F.sum("read").alias("read"), F.sum("there").alias("there")).collect()
    return {(r["seen"], r["true"]): math.log((r["read"] + PRIOR * MISREAD) / (r["there"] + PRIOR)) for r in rows}


def corpus_of(texts: DataFrame) -> Corpus:
    """The model of all texts(text), whole. Every task counts its own first; the counts are then added up by key. Words and pairs that stand there LEAST times, and not less often than RARE, come to the driver."""
    counted = texts.where(F.length("text") > 0).select("text").mapInPandas(_counted, "kind int, key long, word string, n long")
    sums = cut(counted.groupBy("kind", "key", "word").agg(F.sum("n").alias("n")))
    total = sums.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    often = sums.where((F.col("kind") <= 1) & (F.col("n") >= LEAST) & (F.col("n") >= total * RARE)).select("kind", "key", "n").toPandas()
    tables = [Counts(x["key"].to_numpy(dtype=np.int64), x["n"].to_numpy()) for k in (0, 1) for x in (often[often["kind"] == k],)]
    corpus = Corpus(*tables, total, None, learned_headers(sums.where("kind > 1")))
    corpus.channel = learned_channel(sums.where("kind = 0").select("word", "n"), corpus)
    return corpus


@dataclass
class Repaired:
    text: str
    hyphens: list[str]
    misread: list[str]
    headers: int
    pages: int


def changed(word: str) -> Iterator[tuple[str, tuple[str, str]]]:
    """The word with one confusion undone, and which."""
    for seen, true in CONFUSIONS.items():
        at = word.find(seen)
        while at >= 0:
            for t in true:
                yield word[:at] + t + word[at + len(seen) :], (seen, t)
            at = word.find(seen, at + 1)


def candidates(word: str, corpus: Corpus) -> list[tuple[str, float]]:
    """Known words that the scan may have turned into this one, with the logarithm of the channel's probability; the word itself is none of them. More places are sought only where fewer give none."""
    level = {word: 0.0}
    own = corpus.count(word) if not SIGNS & set(word) else 0
    for _ in range(PLACES):
        new: dict[str, float] = {}
        for w, p in level.items():
            for x, pair in changed(w):
                if x != word and (q := p + corpus.confusion(*pair)) > new.get(x, -math.inf):
                    new[x] = q
        found = [(w, p) for w, p in new.items() if w.replace("'", "").replace("-", "").isalpha() and not SIGNS & set(w) and (n := corpus.count(w)) >= LEAST and n >= TIMES * own]
        if found:
            return found
        # where signs must go, only what has fewer of them comes nearer
        left = lambda x: sum(c in SIGNS for c in x)
        level = {w: p for w, p in new.items() if left(w) < left(word)} if left(word) else new
        if not left(word) and _ >= 1:
            break
    return []


def decode(words: list[str], options: list[list[tuple[str, float]] | None], corpus: Corpus) -> list[str]:
    """Viterbi: the words with the highest product of channel and bigram probabilities. Where one word stands for certain, the best path so far is settled."""
    out: list[str] = []
    last = ""
    paths: list[tuple[float, list[str]]] = [(0.0, [])]
    for w, choices in zip(words, options):
        if choices is None:
            if len(paths) > 1:
                paths = [max(((s + corpus.logp(p[-1], w), p) for s, p in paths), key=lambda x: x[0])]
            out += [x.removeprefix(DOUBT) for x in paths[0][1]] + [w]
            last, paths = w or last, [(0.0, [])]
            continue
        paths = [max(((s + channel + corpus.logp(p[-1] if p else last, x), [*p, x]) for s, p in paths), key=lambda y: y[0]) for x, channel in choices]
    return out + [x.removeprefix(DOUBT) for x in max(paths, key=lambda x: x[0])[1]]


def may_be_word(token: str) -> bool:
    """Letters, and signs that scans put in place of letters; no number, ordinal or symbol."""
    return len(token) > 2 and token[0] != "-" and "/" not in token and any(c.isalpha() for c in token) and not ORDINAL.fullmatch(token) and sum(c.isdigit() for c in token) * 2 <= len(token) + 1 and not re.search(r"\d[.,:]\d", token)


def repair(text: str | None, corpus: Corpus) -> Repaired:
    """Readable paragraphs, and what was repaired. Lines of the form of headers or page numbers go; then divided words are joined, and misread ones replaced.

    Three or more bare numbers in lines of their own are a list and stay. A word divided by a hyphen is joined if the corpus has the joined word more often than the compound with its hyphen; an unknown name is joined too, if its second part begins in lower case.
    """
    kept, headers, pages = [], 0, 0
    lines = (text or "").split("\n")
    if len(lines) > 1:
        bare = [x.strip().isdigit() for x in lines]
        for k, line in enumerate(lines):
            x = line.strip()
            if may_be_header(x) and (f := line_form(x)) in corpus.headers and not (bare[k] and any(all(bare[max(0, j) : j + 3]) and j >= 0 and j + 3 <= len(lines) for j in (k - 2, k - 1, k))):
                if sum(c.isalpha() for c in f) < HEADER_LETTERS and "/" not in f.strip("#/ "):
                    pages += 1
                else:
                    headers += 1
            else:
                kept.append(line)
    else:
        kept = lines
    hyphens: list[str] = []

    body, at = "\n".join(kept), 0
    while (m := DIVIDES.search(body, at)) is not None:  # a word may be divided more than once
        at = m.end()
        start = max(body.rfind(x, 0, m.start()) for x in (" ", "\n", "\t", "-")) + 1
        a, b = BEFORE.search(body, start, m.start()), AFTER.match(body, m.end())
        if a is None or b is None:
            continue
        whole = core(a[0] + b[0])
        if corpus.count(core(f"{a[0]}-{b[0]}")) > corpus.count(whole) or not b[0][0].islower() and a[0][-1:].islower():
            continue
        if hyphens and core(a[0]) == hyphens[-1]:
            hyphens.pop()  # divided again
        hyphens.append(whole)
        body = body[: m.start()] + body[m.end() :]
        at = m.start()
    misread: list[str] = []
    split = body.split()
    if corpus.doubtful(split):
        words = [corpus.cores[t] for t in split]
        options = [corpus.options(w) if w else None for w in words]
        best = decode(words, options, corpus)
        at, parts, fixed = 0, [], {}
        for m, w, x in zip(TOKEN.finditer(body), words, best):
            if x == w:
                continue
            t = m[0]
            misread.append(x)
            fixed[w] = x
            i = t.lower().find(w)
            t = t[:i] + (x.upper() if t.isupper() else x.capitalize() if t[i : i + 1].isupper() else x) + t[i + len(w) :]
            parts += [body[at : m.start()], t]
            at = m.end()
        body = "".join(parts) + body[at:]
        hyphens = [fixed.get(h, h) for h in hyphens]
    return Repaired(body, hyphens, misread, headers, pages)


def readable(text: str) -> str:
    """Lines as paragraphs: a single line end is a blank."""
    return re.sub(r"[ \t]+", " ", re.sub(r"(?<!\n)\n(?!\n)", " ", text)).strip()


def repaired_texts(speeches: DataFrame, corpus: Corpus, key: str = "id", text: str = "text", texts: bool = True) -> DataFrame:
    """speech_id, text (readable; only with `texts`), hyphens, misread (words), headers, pages (lines that were taken out) of each row, or, without `texts`, of those where something was repaired; transcripts are left as they are. Null texts stay null, empty ones empty; repeated rows are each repaired."""
    kind = speeches.schema[key].dataType.simpleString()
    sent = speeches.sparkSession.sparkContext.broadcast(corpus)
    columns = ["speech_id", *["text"] * texts, "hyphens", "misread", "headers", "pages"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = sent.value
        for b in batches:
            out = []
            for i, t in zip(b["speech_id"], b["text"]):
                r = repair(t, c) if t else Repaired(t, [], [], 0, 0)
                found = r.hyphens or r.misread or r.headers or r.pages
                if t and (found or texts) and turns(r.text):
                    r, found = Repaired(t, [], [], 0, 0), False
                elif t and texts:
                    r.text = readable(r.text)
                if texts:
                    out.append((i, r.text, r.hyphens, r.misread, r.headers, r.pages))
                elif found:
                    out.append((i, r.hyphens, r.misread, r.headers, r.pages))
            yield pd.DataFrame(out, columns=columns)

    rows = speeches.select(F.col(key).alias("speech_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, f"speech_id {kind}, {'text string, ' * texts}hyphens array<string>, misread array<string>, headers int, pages int")


def _repaired(spark: SparkSession, sf: str, texts: bool) -> DataFrame:
    speeches = load(spark, sf, "speeches", "id", "text")
    return repaired_texts(speeches, corpus_of(speeches), texts=texts)


@query("p7_found")
def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """The kinds of scan noise in each speech, with the repaired words."""
    r = _repaired(spark, sf, False)
    kinds = F.array_compact(
        F.concat(
            F.transform(F.array_distinct("hyphens"), lambda w: F.struct(F.lit("hyphen").alias("kind"), w.alias("repaired"))),
            F.transform(F.array_distinct("misread"), lambda w: F.struct(F.lit("misread").alias("kind"), w.alias("repaired"))),
            F.array(F.when(F.col("headers") > 0, F.struct(F.lit("header").alias("kind"), F.lit("").alias("repaired"))), F.when(F.col("pages") > 0, F.struct(F.lit("page_no").alias("kind"), F.lit("").alias("repaired")))),
        )
    )
    return r.select("speech_id", F.explode(kinds).alias("x")).select("speech_id", "x.kind", "x.repaired").distinct()


@query("p7_texts")
def p7_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The readable text of each speech."""
    return _repaired(spark, sf, True).select("speech_id", "text")
