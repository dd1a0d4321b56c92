"""Encoding of whole corpora with a public byte-level tokenizer, exact for texts of any length.

A text is split by the tokenizer's pattern into pieces, each of which is encoded by itself. Long unsplit text (one piece of many bytes, where merging is slow) and long documents are encoded in halves that are then joined: at each join a window around it, which grows until both sides agree exactly, is encoded again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import Registry
from ..tables import load

query = Registry()

#: The vocabulary file (ranks); the folder is a parameter of every operator here.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the published split pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of more bytes are encoded in halves.
PIECE_BYTES = 512
#: Texts of more characters are cut into leaves of this length, which tasks encode in parallel.
LEAF_CHARS = 1_000_000


class Encoder:
    def __init__(self, path: str, piece_bytes: int = PIECE_BYTES) -> None:
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.core = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(PATTERN)
        self.blank = regex.compile(r"(?r)\s*")  # backwards: the whitespace before a place
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.piece_bytes = piece_bytes

    def merge(self, piece: bytes) -> list[int]:
        return self.core._encode_single_piece(piece)

    def fits(self, a: int, b: int) -> bool:
        """Whether two tokens may stand side by side: their bytes encode to just these two."""
        return self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both sides as one piece.

        A sequence of tokens is the encoding of its bytes if and only if each two neighbours fit, so only the neighbours at the two rims of the window need a look; the window doubles until both fit.
        """
        if not left or not right or self.fits(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = self.tree(b"".join(self.bytes_of[i] for i in left[len(left) - a :] + right[:b]), whole=True)
            ok_left = a == len(left) or self.fits(left[len(left) - a - 1], window[0])
            ok_right = b == len(right) or self.fits(window[-1], right[b])
            if ok_left and ok_right:
                return left[: len(left) - a] + window + right[b:]
            a, b = a if ok_left else 2 * a, b if ok_right else 2 * b

    def tree(self, piece: bytes, whole: bool = False) -> list[int]:
        """Encodes one piece; with `whole` without halving, where it isn't too long for that."""
        if len(piece) <= self.piece_bytes * (8 if whole else 1):
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def encode(self, text: str) -> list[int]:
        """Exactly the ids of the public tokenizer without special tokens, whose strings are ordinary text."""
        if len(text) <= self.piece_bytes // 4:  # no piece can be long
            return self.core.encode_ordinary(text)
        ids: list[int] = []
        start = done = 0
        for m in self.split.finditer(text):
            if m.end() - m.start() > self.piece_bytes // 4:
                # the pattern looks at what follows whitespace, so whitespace before the long piece keeps its pieces from the whole text
                solid = self.blank.match(text, done, m.start()).start()
                ids += self.core.encode_ordinary(text[done:solid]) if done < solid else []
                for s in self.split.finditer(text, solid):
                    if s.start() == m.start():
                        break
                    ids += self.tree(s[0].encode("utf-8", "replace"))
                ids += self.tree(m[0].encode("utf-8", "replace"))
                done = m.end()
            start = m.end()
        assert start == len(text)
        return ids + self.core.encode_ordinary(text[done:]) if done else self.core.encode_ordinary(text)

    def leaf(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """Ids, and for each piece its characters and its tokens."""
        ids, chars, tokens = [], [], []
        for m in self.split.finditer(text):
            new = self.tree(m[0].encode("utf-8", "replace"))
            ids += new
            chars.append(m.end() - m.start())
            tokens.append(len(new))
        return ids, chars, tokens

    def join_leaves(self, left: tuple, right: tuple, left_text: str, right_text: str) -> tuple:
        """Joins two neighbouring stretches of a text.

        The pattern looks at most two characters ahead (for 'll and the like) and never back, so all pieces of the left but its last two stay; from there on text is split again until a piece ends where one of the right does, and from that point the right's pieces stay. If a piece runs on to the end of what is looked at, more is taken.
        """
        if not left[1]:
            return right
        if not right[1]:
            return left
        tail = left_text[len(left_text) - sum(left[1][-2:]) :]
        ends, at = {}, len(tail)
        for k, n in enumerate(right[1]):
            at += n
            ends[at] = k + 1
        grow = 64
        while True:
            window = tail + right_text[:grow]
            whole = grow >= len(right_text)
            new, keep, kept = [], None, 0
            for m in self.split.finditer(window):
                if m.end() + 2 >= len(window) and not whole:
                    break  # more text might change this piece
                new.append(m[0])
                kept = m.end()
                if kept > len(tail) and kept in ends:
                    keep = ends[kept]
                    break
            if keep is not None:
                break
            if whole:
                keep = len(right[1])
                break
            grow *= 4
        parts = [self.tree(x.encode("utf-8", "replace")) for x in new]
        drop_left, drop_right = sum(left[2][-2:]), sum(right[2][:keep])
        ids = left[0][: len(left[0]) - drop_left] + [i for p in parts for i in p] + right[0][drop_right:]
        return ids, left[1][:-2] + [len(x) for x in new] + right[1][keep:], left[2][:-2] + [len(p) for p in parts] + right[2][keep:]


@lru_cache(maxsize=4)
def encoder(path: str, piece_bytes: int = PIECE_BYTES) -> Encoder:
    return Encoder(path, piece_bytes)


def encode_texts(docs: DataFrame, key: str, text: str, folder: str = TOKENIZERS, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """One row (key, ids) for each row of docs. Null and empty texts give an empty list; blank texts are encoded like others; rows with a null or repeated key are encoded each by itself."""
    path, kind = f"{folder}/{VOCABULARY}", docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"{key} {kind}, ids array<int>"

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path)
        for b in batches:
            yield pd.DataFrame({key: b["key"], "ids": [e.encode(t) if t else [] for t in b["text"]]})

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path)
        for b in batches:
            done = [e.leaf(t) for t in b["text"]]
            yield b.assign(ids=[x[0] for x in done], chars=[x[1] for x in done], tokens=[x[2] for x in done])

    def tree(b: pd.DataFrame) -> pd.DataFrame:
        e = encoder(path)
        b = b.sort_values("leaf")
        parts = [((list(i), list(c), list(n)), t) for i, c, n, t in zip(b["ids"], b["chars"], b["tokens"], b["text"])]
        while len(parts) > 1:
            parts = [(e.join_leaves(a[0], c[0], a[1], c[1]), a[1] + c[1]) for a, c in zip(parts[::2], parts[1::2])] + ([parts[-1]] if len(parts) % 2 else [])
        return pd.DataFrame({key: b["key"].iloc[:1], "n": b["n"].iloc[:1], "ids": [parts[0][0][0]]})

    is_long = F.coalesce(F.length("text") > leaf_chars, F.lit(False))
    short = rows.where(~is_long).mapInPandas(whole, schema)
    long = rows.where(is_long).groupBy("key", "text").agg(F.count("*").alias("n")).withColumn("doc", F.xxhash64("key", "text"))
    cut = long.select("key", "doc", "n", F.posexplode(F.expr(f"transform(sequence(0, cast((length(text) - 1) div {leaf_chars} as int)), i -> substring(text, i * {leaf_chars} + 1, {leaf_chars}))")).alias("leaf", "text"))
    spread = cut.repartition(F.col("doc"), F.col("leaf")).mapInPandas(leaves, f"key {kind}, doc long, n long, leaf int, text string, ids array<int>, chars array<int>, tokens array<int>")
    joined = spread.groupBy("doc").applyInPandas(tree, f"{key} {kind}, n long, ids array<int>")  # a group is one document
    return short.unionByName(joined.select(key, "ids", F.explode(F.expr("sequence(1, n)")).alias("_")).drop("_"))


@query("p8_ids")
def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The ids of each document's text by byte_bpe_50k."""
    return encode_texts(load(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")


@query("p8_lengths")
def p8_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and tokens by language."""
    docs = load(spark, sf, "documents", "doc_id", "lang")
    ids = encode_texts(load(spark, sf, "documents", "doc_id", "text"), "doc_id", "text").select("doc_id", F.size("ids").alias("n"))
    return ids.join(docs, "doc_id").groupBy("lang").agg(F.count("*").alias("documents"), F.sum("n").alias("tokens"))
