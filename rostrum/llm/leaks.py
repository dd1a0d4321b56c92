"""Evaluation texts that leak into training text: suffix arrays of the training text, searched for every suffix of every test item."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import Registry
from ..tables import load

query = Registry()

#: Shortest verbatim match in words; a single word says nothing.
SEED = 2
#: Share of an item's words that must stand in the document.
SHARE = 0.5
#: Words that may stand between two passages of one item (a sentence or two).
GAP = 60
#: A task closes a shard after so many words; the result doesn't depend on it.
SHARD_WORDS = 2_000_000
#: The test items must stay under this, as every task holds them. Beyond it, run the operator for parts of them.
MOST_ITEM_CHARS = 20_000_000

WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Words in lower case and compatibility form, without punctuation and spacing."""
    return WORD.findall(unicodedata.normalize("NFKC", text).replace("­", "").lower())


class Items:
    """The test items: their words as codes, and all their suffixes of SEED words or more."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        self.ids = np.array([i for i, _ in rows], dtype=np.int64)
        split = [words(t) for _, t in rows]
        self.vocabulary = {w: k + 1 for k, w in enumerate(sorted({w for x in split for w in x}))}  # 0: any other word, matches nothing
        self.length = np.array([len(x) for x in split], dtype=np.int64)
        self.codes = np.array([c for x in split for c in (*(self.vocabulary[w] for w in x), 0)], dtype=np.int64)
        pair = self.pairs_of(self.codes)
        self.pairs = np.unique(pair[pair > 0])
        self.starts = np.flatnonzero(pair)
        item = np.repeat(np.arange(len(rows)), self.length + 1)
        at = np.concatenate([np.arange(n + 1) for n in self.length]) if len(rows) else np.zeros(0, dtype=np.int64)
        self.item, self.at = item[self.starts], at[self.starts]

    def pairs_of(self, codes: np.ndarray) -> np.ndarray:
        """For each place the two words that begin there as one number; 0 where either matches nothing."""
        out = np.zeros(len(codes), dtype=np.int64)
        if len(codes) > 1:
            out[:-1] = np.where((codes[:-1] > 0) & (codes[1:] > 0), codes[:-1] * (len(self.vocabulary) + 1) + codes[1:], 0)
        return out


class Suffixes:
    """Suffixes of a coded text in their order, with what it takes to compare any two of them at once.

    A suffix is a run of places that follow each other in `places`. Ranks double: after k rounds, equal ranks mean that suffixes agree over 2^k places (or end alike), and greater ranks follow in the order of suffixes.
    """

    def __init__(self, places: np.ndarray, symbols: np.ndarray) -> None:
        n = len(places)
        ends = np.ones(n, dtype=bool)
        ends[:-1] = places[1:] != places[:-1] + 1
        last = np.flatnonzero(ends)
        self.run = (last[np.searchsorted(last, np.arange(n))] - np.arange(n) + 1) if n else np.zeros(0, dtype=np.int64)
        self.ranks = [np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1]
        while n and (step := 1 << (len(self.ranks) - 1)) < self.run.max():
            r = self.ranks[-1]
            second = np.zeros(n, dtype=np.int64)
            more = np.flatnonzero(self.run > step)
            second[more] = r[more + step]
            self.ranks.append(np.unique(r * (n + 1) + second, return_inverse=True)[1].astype(np.int64) + 1)

    def order(self, among: np.ndarray) -> np.ndarray:
        """The suffix array: the suffixes `among` in their order."""
        return among[np.argsort(self.ranks[-1][among], kind="stable")]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Over how many places each pair of suffixes agrees."""
        a, b = a.copy(), b.copy()
        done = np.zeros(len(a), dtype=np.int64)
        live = np.arange(len(a))
        for k in range(len(self.ranks) - 1, -1, -1):
            x, y = a[live] + done[live], b[live] + done[live]
            same = self.ranks[k][x] == self.ranks[k][y]
            done[live[same]] += np.minimum(1 << k, self.run[x[same]])
            live = live[(done[live] < self.run[a[live]]) & (done[live] < self.run[b[live]])]
        return done


def search(codes: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, Suffixes, np.ndarray]:
    """The matches of all test suffixes in a shard: (test suffix, suffix of the shard) that agree over SEED words or more; and the suffixes of the items and of the shard, with the place of each.

    The suffix array holds the places of the shard where two words stand that follow each other in some item (no other place can match). Every test suffix is looked up in it by binary search: the suffixes that agree with it over SEED words lie side by side, the longest matches next to where it would stand itself.
    """
    pair = items.pairs_of(codes)
    slot = np.minimum(np.searchsorted(items.pairs, pair), max(0, len(items.pairs) - 1))
    here = np.flatnonzero(items.pairs[slot] == pair) if len(items.pairs) else np.zeros(0, dtype=np.int64)
    offset = len(items.codes) + 1
    places = np.concatenate([items.starts, here + offset])
    both = Suffixes(places, np.concatenate([items.pairs_of(items.codes)[items.starts], pair[here]]))
    tests = len(items.starts)
    array = both.order(np.arange(tests, len(places)))
    first = both.ranks[0]
    low = np.searchsorted(first[array], first[:tests], side="left")
    high = np.searchsorted(first[array], first[:tests], side="right")
    n = high - low
    suffix = np.repeat(np.arange(tests), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    return suffix, array[at], both, places - offset


def longest(codes: np.ndarray, items: Items) -> list[tuple[int, int]]:
    """For each test suffix the words of its longest match in the shard, and where one begins (-1: there is none): of the two neighbours of the place in the suffix array where the test suffix would stand, the one that agrees longer."""
    _, _, both, places = search(codes, items)
    tests = np.arange(len(items.starts))
    array = both.order(np.arange(len(tests), len(places)))
    if not len(array):
        return [(0, -1)] * len(tests)
    place = np.searchsorted(both.ranks[-1][array], both.ranks[-1][tests])
    before, after = array[np.maximum(place - 1, 0)], array[np.minimum(place, len(array) - 1)]
    a, b = both.common(tests, before), both.common(tests, after)
    return [(int(max(x, y)) + 1, int(places[p if x >= y else q])) if max(x, y) else (0, -1) for x, y, p, q in zip(a, b, before, after)]


#: A verbatim match: place in the item, place in the text, words.
Match = tuple[int, int, int]


def chain(found: list[Match]) -> tuple[int, list[tuple[int, int]]]:
    """The most words of the item that stand in its order, with GAP words at most between two matches; and the stretches of the text that hold them."""
    found = sorted(found, key=lambda s: s[1])
    most = max(n for _, _, n in found)
    best: list[int] = []
    back: list[int] = []
    for k, (i, d, n) in enumerate(found):
        best.append(n)
        back.append(-1)
        for j in range(k - 1, -1, -1):
            pi, pd_, pn = found[j]
            if d - pd_ > GAP + most:
                break  # so do all before it
            if d - (pd_ + pn) > GAP or i <= pi or d <= pd_:
                continue
            lap = max(0, pi + pn - i, pd_ + pn - d)
            if lap < n and best[j] + n - lap > best[k]:
                best[k], back[k] = best[j] + n - lap, j
    k = max(range(len(best)), key=best.__getitem__)
    score, spans = best[k], []
    while k >= 0:
        spans.append((found[k][1], found[k][1] + found[k][2]))
        k = back[k]
    return score, spans


def apart(found: list[Match], taken: set[int]) -> list[Match]:
    """What is left of the matches outside of the taken places of the text."""
    out = []
    for i, d, n in found:
        a = 0
        for b in range(n + 1):
            if b == n or d + b in taken:
                if b - a >= SEED:
                    out.append((i + a, d + a, b - a))
                a = b + 1
    return out


def leaked(by_item: dict[int, list[Match]], length: np.ndarray, share: float) -> list[tuple[int, float]]:
    """The items that leaked into one document, with the share of their words.

    Items share turns of phrase, so a stretch of text speaks for one item only: the item with the highest share takes its stretches, and the others are measured on the rest.
    """
    out = []
    open_ = by_item
    while open_:
        scored = {i: chain(p) for i, p in open_.items()}
        i = max(scored, key=lambda x: (scored[x][0] / length[x], -x))
        score, spans = scored[i]
        if score < share * length[i]:
            break
        out.append((i, score / length[i]))
        taken = {x for a, b in spans for x in range(a, b)}
        open_ = {j: q for j, p in open_.items() if j != i and scored[j][0] >= share * length[j] and (q := apart(p, taken))}
    return out


def in_shard(codes: np.ndarray, starts: np.ndarray, items: Items, share: float) -> Iterator[tuple[int, int, float]]:
    """text, item, share of the items that leaked into the texts of a shard, which begin at `starts`."""
    suffix, match, both, places = search(codes, items)
    if not len(suffix):
        return
    doc = np.searchsorted(starts, places[match], side="right") - 1
    pair, most = doc * len(items.ids) + items.item[suffix], int(items.length.max()) + 2
    # words of the item that stand anywhere in the text with a neighbour; no chain can have more
    covered = np.unique(pair * most + items.at[suffix])
    owner = covered // most
    run_ends = np.ones(len(covered), dtype=bool)
    run_ends[:-1] = covered[1:] != covered[:-1] + 1
    known, inverse = np.unique(owner, return_inverse=True)
    n = np.bincount(inverse, weights=1 + run_ends)
    keep = np.isin(pair, known[n >= share * items.length[known % len(items.ids)]])
    suffix, match, doc = suffix[keep], match[keep], doc[keep]
    # of the matches of one passage the one that begins first is the whole
    whole = np.ones(len(suffix), dtype=bool)
    again = np.flatnonzero((items.at[suffix] > 0) & (match > len(items.starts)))
    s, m = suffix[again] - 1, match[again] - 1
    whole[again] = ~((both.run[s] > 1) & (both.run[m] > 1) & (m >= len(items.starts)) & (both.ranks[0][s] == both.ranks[0][m]))
    suffix, match, doc = suffix[whole], match[whole], doc[whole]
    words_ = both.common(suffix, match) + 1
    found: dict[int, dict[int, list[Match]]] = defaultdict(lambda: defaultdict(list))
    for d, i, x, p, k in zip(doc.tolist(), items.item[suffix].tolist(), items.at[suffix].tolist(), places[match].tolist(), words_.tolist()):
        found[d][i].append((x, p, k))
    for d, by_item in found.items():
        for i, part in leaked(by_item, items.length, share):
            yield d, i, part


def find_leaks(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, share for each document and item where at least `share` of the item's words stand in the document as running passages in the item's order.

    docs(doc_id, text) is searched where it lies, without a shuffle: every task builds the suffix array of its shard (of its part of the rows). items(item_id, text), the held-out set, goes to every task; its size is checked against MOST_ITEM_CHARS. Case, punctuation and spacing don't count; changed words interrupt a passage but don't end it (two neighbouring words are a match), nor does a foreign sentence of up to GAP words. Null or empty texts on either side match nothing; items under two words can't be found. Repeated documents each get their rows.
    """
    spark = docs.sparkSession
    held_out = items.select(F.col("item_id").cast("long"), F.col("text")).where(F.col("text").isNotNull())
    if (size := held_out.agg(F.sum(F.length("text"))).first()[0] or 0) > MOST_ITEM_CHARS:
        raise ValueError(f"the test items have {size} characters, more than {MOST_ITEM_CHARS}; search for parts of them")
    rows = spark.sparkContext.broadcast([(r[0], r[1]) for r in held_out.distinct().orderBy("item_id").collect()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        test = Items(rows.value)
        known = test.vocabulary
        ids: list = []
        parts: list[list[int]] = []
        starts: list[int] = []
        size = 0

        def shard() -> pd.DataFrame:
            codes = np.array([c for p in parts for c in p], dtype=np.int64)
            out = [(ids[d], test.ids[i], s) for d, i, s in in_shard(codes, np.array(starts), test, share)] if len(test.ids) else []
            return pd.DataFrame(out, columns=["doc_id", "item_id", "share"])

        for b in batches:
            for i, t in zip(b["doc_id"], b["text"]):
                parts.append([*(known.get(w, 0) for w in words(t)), 0])  # no match runs over the end of a text
                ids.append(i)
                starts.append(size)
                size += len(parts[-1])
                if size >= SHARD_WORDS:
                    yield shard()
                    ids, parts, starts, size = [], [], [], 0
        yield shard()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").where(F.length("text") > 0).mapInPandas(run, f"doc_id {kind}, item_id long, share double")


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """docs without those that hold a leaked item."""
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti")


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(load(spark, sf, "documents", "doc_id", "text"), load(spark, sf, "benchmark", "item_id", "text"))


@query("p9_found")
def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and the items that leaked into them."""
    return _leaks(spark, sf).select("doc_id", "item_id").distinct()


@query("p9_items")
def p9_items(spark: SparkSession, sf: str) -> DataFrame:
    """For each item that leaked: the number of documents, and the largest share of it in one."""
    return _leaks(spark, sf).groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max("share").alias("share"))


@query("p9_clean")
def p9_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The documents that stay for training."""
    return without_leaks(load(spark, sf, "documents", "doc_id", "lang", "source"), _leaks(spark, sf))
