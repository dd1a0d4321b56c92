import random

import pytest
from pyspark.sql import types as T

from rostrum.llm.encode import TOKENIZERS, VOCABULARY, Encoder, encode_texts

tokenizers = pytest.importorskip("tokenizers")
ALPHABETS = ("ab", "abcde   ", "etaoin", "   \n\t a", "аб в", "日本 ", "!?.-  x", "<|endoftext|>", "0123", "á‍ ", "'s 'll")


def reference():
    t = tokenizers.Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


def random_texts(n, seed=1):
    r = random.Random(seed)
    for _ in range(n):
        letters = r.choice(ALPHABETS)
        yield "".join(r.choice(letters) for _ in range(r.randrange(0, 700)))


def test_halves_and_leaves_join_exactly():
    expected, small = reference(), Encoder(f"{TOKENIZERS}/{VOCABULARY}", piece_bytes=16)
    r = random.Random(2)
    for x in random_texts(600):
        want = expected(x)
        assert small.encode(x) == want
        c = r.randrange(0, len(x) + 1)
        ids, chars, _ = small.join_leaves(small.leaf(x[:c]), small.leaf(x[c:]), x[:c], x[c:])
        assert ids == want
        assert chars == [len(m[0]) for m in small.split.finditer(x)]


def test_frame_of_any_texts(spark):
    expected = reference()
    texts = [None, "", "   ", "<|endoftext|>", *random_texts(40, seed=3), "ab " * 3000]
    rows = [(i, x, "clash") for i, x in enumerate(texts)] + [(7, texts[7], "clash"), (len(texts) - 1, texts[-1], "clash")]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType())]))
    got = sorted((r["doc_id"], list(r["ids"])) for r in encode_texts(df, "doc_id", "text", leaf_chars=97).collect())
    assert got == sorted((i, expected(x) if x else []) for i, x, _ in rows)
    assert encode_texts(df.where("false"), "doc_id", "text").count() == 0


def test_whitespace_before_a_long_piece():
    expected, e = reference(), Encoder(f"{TOKENIZERS}/{VOCABULARY}")
    for gap in ("\n\n", " \n", "\n\n\n", "\r\n\t", " \u00a0", "\n \n ", "\n" * 300):
        for long in ("ab" * 100, "日" * 200, "-" * 200, "=" * 129, "7" * 300):
            text = f"Text.{gap}{long}{gap}{long}{gap}"
            assert e.encode(text) == e.leaf(text)[0] == expected(text)
    assert e.encode("Text.\n\n" + "ab" * 100)[:5] == [8206, 13, 198, 198, 397]
