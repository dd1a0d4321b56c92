"""Subject areas of documents, by interpolated n-gram models that are compared with background models.

For each subject there is a bigram model, trained on labelled documents. It is interpolated with its unigrams and with the background model, which counts the bigrams of all documents. A sentence speaks for the subject whose model gives it the lowest cross-entropy, if that keeps up with the background, beats two further background models (that of the held-out test items, for leaked passages, and that of passing remarks, which are sentences of labelled documents on subjects that these don't have) and leads the next subject by enough. How much is enough is calibrated on labelled documents that trained nothing.

Counts are exact. Models have the size of the bounded sample that trains them; the background leaves out what is rarer than RARE, so that it has a bounded size too.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import Registry
from ..runtime import cut
from ..tables import load

query = Registry()

#: The bound of the sample of labelled documents that train the models; of more, those with the lowest hash of their id are taken.
LABELLED = 20_000
#: One in so many labelled documents calibrates and trains nothing.
HELD_OUT = 5
#: Words and bigrams with a smaller share of the corpus, or one find only, count as unseen in the background; so its table has fewer than 3 / RARE entries, of 12 bytes.
RARE, LEAST = 1 / (1 << 23), 2
#: Interpolation: how many observations the lower model counts for, in the background (bigrams over unigrams), in a model's unigrams (over the background's) and in its bigrams (over the background's bigrams, mixed with its own unigrams by the share MIXED).
OVER_UNIGRAMS, OVER_BACKGROUND, OVER_BIGRAMS, MIXED = 5.0, 500.0, 5.0, 0.5
#: What is taken off each count of a subject's model, so that chance finds weigh nothing: so many standard deviations of a count.
DISCOUNT = 0.5
#: Nats by which a sentence of a labelled document must speak for a foreign subject to count as a passing remark.
REMARK = 3.0
#: Nats by which a sentence that speaks for a subject may fall short of the background (which knows more rare words).
SHORT = 1.0
#: Candidates for the nats by which the best subject of a sentence must beat the second.
LEADS = (1.0, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0, 6.0, 8.0)
#: Candidates for the nats a token by which it must.
RATES = (0.0, 0.05, 0.1, 0.2, 0.3, 0.45)

WORD = re.compile(r"[^\W\d_]+")
TORN = re.compile(r"(?<=\w)(?:-|­)[ \t]*\n\s*(?=[^\W\d_])|(?<=[^\W\d_])- +(?=[^\W\d_])|­")
END = re.compile(r"[.!?…]\s+|\n\s*\n")


#: What isn't a letter, of ASCII, as blanks.
NO_LETTERS = "".join(chr(c) if chr(c).isalpha() else " " for c in range(128))


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence in lower case; words that a line end tears apart are joined first."""
    if not (plain := text.isascii()):
        text = unicodedata.normalize("NFKC", text)
    if "- " in text or "-\n" in text or "-\t" in text or "\xad" in text:
        text = TORN.sub("", text)
    split = END.split(text.lower())
    return [w for s in split if (w := s.translate(NO_LETTERS).split() if plain else WORD.findall(s))]


class Codes(dict):
    """64 bits for each word."""

    def __missing__(self, word: str) -> int:
        if len(self) > 2_000_000:
            self.clear()
        self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace")) | 1
        return self[word]


_codes = Codes()


@dataclass
class Coded:
    """Sentences as arrays: of each token its own and its predecessor's code (0: it is the first), and where sentences begin."""

    word: np.ndarray
    before: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, split: list[list[str]]) -> Coded:
        word = np.array([_codes[w] for s in split for w in s], dtype=np.uint64)
        begins = np.cumsum([0, *map(len, split)], dtype=np.int64)[:-1]
        before = np.zeros_like(word)
        before[1:] = word[:-1]
        before[begins[begins < len(before)]] = 0
        return cls(word, before, begins)


def keys(word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys under which a word, a predecessor and a bigram are counted."""
    mixed = (before * np.uint64(0x85EBCA77C2B2AE63) + np.uint64(7)) ^ (word * np.uint64(0xC2B2AE3D27D4EB4F))
    return word.view(np.int64), (before * np.uint64(0x9E3779B97F4A7C15) + np.uint64(3)).view(np.int64), ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


ROWS = "name string, kind int, key long, n long"
#: After so many tokens a task gives away what it has counted.
FLUSH = 1_000_000


class Tally:
    """The counts of a task: words (kind 0), predecessors (1) and bigrams (2) under names."""

    def __init__(self) -> None:
        self.of: dict[str, list[Coded]] = {}
        self.size = 0

    def add(self, name: str, coded: Coded) -> None:
        if len(coded.word):
            self.of.setdefault(name, []).append(coded)
            self.size += len(coded.word)

    def rows(self) -> pd.DataFrame:
        out = []
        for name, parts in self.of.items():
            for kind, k in enumerate(keys(np.concatenate([c.word for c in parts]), np.concatenate([c.before for c in parts]))):
                u, n = np.unique(k, return_counts=True)
                out.append(pd.DataFrame({"name": name, "kind": np.int32(kind), "key": u, "n": n}))
        self.of, self.size = {}, 0
        return pd.concat(out) if out else pd.DataFrame({"name": pd.Series(dtype=object), "kind": pd.Series(dtype=np.int32), "key": pd.Series(dtype=np.int64), "n": pd.Series(dtype=np.int64)})


def counted(df: DataFrame, count: Callable[[pd.DataFrame, Tally], None]) -> DataFrame:
    """name, kind, key, n of what `count` puts into tallies. Every task adds up its own first; the counts are then added up by key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = Tally()
        for b in batches:
            count(b, t)
            if t.size > FLUSH:
                yield t.rows()
        yield t.rows()

    return df.mapInPandas(run, ROWS).groupBy("name", "kind", "key").agg(F.sum("n").alias("n"))


class Table:
    """Counts by key, a row for each name; keys that aren't there have 0."""

    def __init__(self, rows: pd.DataFrame, names: list[str]) -> None:
        self.keys, place = np.unique(rows["key"].to_numpy(dtype=np.int64), return_inverse=True)
        self.counts = np.zeros((len(names), len(self.keys) + 1), dtype=np.float32)
        at = {n: k for k, n in enumerate(names)}
        np.add.at(self.counts, (rows["name"].map(at).to_numpy(dtype=np.int64), place), rows["n"].to_numpy())

    def of(self, key: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros((len(self.counts), len(key)), dtype=np.float32)
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return self.counts[:, np.where(self.keys[at] == key, at, len(self.keys))]


def sure(counts: np.ndarray) -> np.ndarray:
    return np.maximum(0, counts - DISCOUNT * np.sqrt(counts))


class Models:
    """The background and the models that are compared with it; `subjects` of `names` are subjects, the rest further backgrounds."""

    def __init__(self, background: pd.DataFrame, tokens: float, words: int, models: pd.DataFrame, subjects: list[str]) -> None:
        known = set(models["name"])
        self.subjects = [s for s in subjects if s in known]
        self.names = self.subjects + sorted(known - {*self.subjects})
        self.background = Table(background.assign(name=""), [""])
        self.tokens, self.words = tokens, words
        self.models = Table(models, self.names)
        self.sizes = np.array([models.loc[(models["name"] == n) & (models["kind"] == 0), "n"].sum() for n in self.names], dtype=np.float32)[:, None]

    def gains(self, coded: Coded) -> np.ndarray:
        """For each sentence and model: the nats by which the model's cross-entropy lies below the background's, over all its tokens."""
        if not len(coded.begins):
            return np.zeros((0, len(self.names)), dtype=np.float32)
        both, first, place = np.unique(keys(coded.word, coded.before)[2], return_index=True, return_inverse=True)
        word, before, _ = keys(coded.word[first], coded.before[first])
        w, w_at = np.unique(word, return_inverse=True)
        b, b_at = np.unique(before, return_inverse=True)
        unigram = ((self.background.of(w)[0] + 0.5) / (self.tokens + 0.5 * self.words))[w_at]
        bigram = (self.background.of(both)[0] + OVER_UNIGRAMS * unigram) / (self.background.of(b)[0][b_at] + OVER_UNIGRAMS)
        out = np.empty((len(coded.begins), len(self.names)), dtype=np.float32)
        own_w, own_b, own_both = sure(self.models.of(w)), self.models.of(b), sure(self.models.of(both))
        for k in range(len(self.names)):
            own = (own_w[k][w_at] + OVER_BACKGROUND * unigram) / (self.sizes[k, 0] + OVER_BACKGROUND)
            lower = (1 - MIXED) * bigram + MIXED * own
            gain = np.log((own_both[k] + OVER_BIGRAMS * lower) / ((own_b[k][b_at] + OVER_BIGRAMS) * bigram)).astype(np.float32)
            out[:, k] = np.add.reduceat(gain[place], coded.begins)
        return out

    def speaking(self, gains: np.ndarray, lengths: np.ndarray, least: float, rate: float = 0.0) -> np.ndarray:
        """The subject that each sentence speaks for, -1 for none: its model must be the best of all, keep up with the background, and lead the next subject by `least` nats, and by `rate` nats a token (the difference of their cross-entropies)."""
        n = len(self.subjects)
        if not len(gains) or not n:
            return np.full(len(gains), -1, dtype=np.int64)
        best = gains.argmax(axis=1)
        among = np.sort(np.column_stack([gains[:, :n], np.full(len(gains), -1e9)]), axis=1)
        lead = among[:, -1] - among[:, -2]
        return np.where((best < n) & (among[:, -1] > -SHORT) & (lead >= least) & (lead >= rate * lengths), best, -1)


def _grouped(b: pd.DataFrame, models: Models, *least: float) -> Iterator[tuple[int, list[list[str]], np.ndarray, np.ndarray]]:
    """Row, sentences, gains (or, with `least`, the subjects that they speak for), lengths; many texts are measured at once."""
    held, size = [], 0
    for k, t in enumerate(b["text"]):
        s = sentences(t) if t else []
        held.append((k, s))
        size += sum(map(len, s))
        if size > 200_000 or k == len(b) - 1:
            every = [x for _, s in held for x in s]
            gains, lengths = models.gains(Coded.of(every)), np.fromiter(map(len, every), dtype=np.float32, count=len(every))
            if least:
                gains = models.speaking(gains, lengths, *least)
            at = 0
            for j, s in held:
                yield j, s, gains[at : at + len(s)], lengths[at : at + len(s)]
                at += len(s)
            held, size = [], 0


def train(docs: DataFrame, labels: DataFrame, held_out_items: DataFrame | None = None, bound: int = LABELLED) -> tuple[Models, tuple[float, float]]:
    """The models, and the calibrated least lead of a sentence, in nats and in nats a token.

    docs(doc_id, text), labels(doc_id, subject), held_out_items(text). The background counts all docs. Of more than `bound` labelled documents those with the lowest hash of their id are taken. Documents with one subject train its model; every fifth document by hash only calibrates. Labels without document, and null subjects, are left out.
    """
    spark = docs.sparkSession
    by_doc = labels.where(F.col("subject").isNotNull()).groupBy("doc_id").agg(F.sort_array(F.collect_set("subject")).alias("subjects"))
    chosen = by_doc.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(bound)
    sample = cut(docs.where(F.length("text") > 0).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "subjects", (F.pmod("h", F.lit(HELD_OUT)) == 0).alias("calibrates")))  # `bound` rows at most

    def all_text(b: pd.DataFrame, c: Tally) -> None:
        c.add("\x01leak", Coded.of([s for t in b["text"] if t for s in sentences(t)]))

    def own_text(b: pd.DataFrame, c: Tally) -> None:
        for s, t in zip(b["subjects"], b["text"]):
            c.add(s[0], Coded.of(sentences(t)))

    everything = cut(counted(docs.where(F.length("text") > 0).select("text"), all_text))
    size = everything.where("kind = 0").agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).first()
    tokens, words = float(size["tokens"] or 0), size["words"]
    background = everything.where((F.col("n") >= LEAST) & (F.col("n") >= tokens * RARE)).select("kind", "key", "n").toPandas()
    trains = sample.where(~F.col("calibrates"))
    models = counted(trains.where(F.size("subjects") == 1).select("text", "subjects"), own_text).toPandas()
    subjects = sorted(set(models["name"]))
    if held_out_items is not None:
        models = pd.concat([models, counted(held_out_items.where(F.length("text") > 0).select("text"), all_text).toPandas()])
    first = spark.sparkContext.broadcast(Models(background, tokens, words, models, subjects))

    def remarks(b: pd.DataFrame, c: Tally) -> None:
        m = first.value
        for k, split, said, _ in _grouped(b, m, REMARK):
            own = set(b["subjects"].iloc[k])
            c.add("\x02remark", Coded.of([s for s, x in zip(split, said) if x >= 0 and m.subjects[x] not in own]))

    models = pd.concat([models, counted(trains.select("text", "subjects"), remarks).toPandas()])
    final = Models(background, tokens, words, models, subjects)
    sent = spark.sparkContext.broadcast(final)

    def outcomes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for b in batches:
            rows = []
            for k, _, gains, lengths in _grouped(b, m):
                own = set(b["subjects"].iloc[k])
                for g in LEADS:
                    for r in RATES:
                        got = {m.subjects[x] for x in m.speaking(gains, lengths, g, r) if x >= 0}
                        rows.append((g, r, len(got & own), len(got), len(own)))
            yield pd.DataFrame(rows, columns=["g", "r", "both", "got", "own"])

    measured = sample.where("calibrates").select("text", "subjects").mapInPandas(outcomes, "g double, r double, both long, got long, own long").groupBy("g", "r").agg(F.sum("both").alias("both"), F.sum("got").alias("got"), F.sum("own").alias("own")).collect()
    score = {(x["g"], x["r"]): 2 * x["both"] / max(1, x["got"] + x["own"]) for x in measured}
    return final, max(((g, r) for g in LEADS for r in RATES), key=lambda x: (score.get(x, 0.0), x[0], -x[1]))


def assign(docs: DataFrame, models: Models, least: tuple[float, float]) -> DataFrame:
    """doc_id, subject, sentences: the subjects that sentences of a document speak for, with their number. Every text is read whole; null, empty and blank texts have no subject; repeated rows each get theirs."""
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for b in batches:
            rows = []
            for k, _, said, _ in _grouped(b, m, *least):
                spoken = np.bincount(said + 1, minlength=len(m.subjects) + 1)[1:]
                rows += [(b["doc_id"].iloc[k], m.subjects[x], int(spoken[x])) for x in np.flatnonzero(spoken)]
            yield pd.DataFrame(rows, columns=["doc_id", "subject", "sentences"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").where(F.length("text") > 0).mapInPandas(run, f"doc_id {kind}, subject string, sentences long")


def _assigned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs, labels = load(spark, sf, "documents", "doc_id", "text"), load(spark, sf, "labels", "doc_id", "subject")
    models, least = train(docs, labels, load(spark, sf, "benchmark", "text"))
    return assign(docs, models, least), labels


@query("p10_found")
def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """The subject areas of all documents without labels."""
    found, labels = _assigned(spark, sf)
    return found.join(labels.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "subject").distinct()


@query("p10_mix")
def p10_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus by subject: documents, and sentences that speak for it. Documents with labels count by these."""
    found, labels = _assigned(spark, sf)
    own = found.join(labels, ["doc_id", "subject"], "left_semi")
    free = found.join(labels.select("doc_id").distinct(), "doc_id", "left_anti")
    return own.unionByName(free).groupBy("subject").agg(F.countDistinct("doc_id").alias("documents"), F.sum("sentences").alias("sentences"))
