import math
import random
from collections import Counter

import numpy as np
import pytest

from rostrum.llm.noise import Corpus, Counts, corpus_of, key_of, line_form, may_be_header, may_be_word, readable, repair, repaired_texts

CLEAN = "The delegation of Nuskosuru proposed that relief workers should be taken up first before the next session. Our views are well-known in the morning. They will say what all of us can see. "
HEADERS = frozenset(("page #", "s/pv.#", "#", "general assembly a/#/pv.#"))


def counts(c):
    return Counts(np.array([key_of(*k) for k in c], dtype=np.int64), np.array([*c.values()]))


@pytest.fixture(scope="module")
def corpus():
    words = [w.lower().strip(".") for w in (CLEAN * 60).split()]
    return Corpus(counts(Counter((w,) for w in words)), counts(Counter(zip(words, words[1:]))), len(words), None, HEADERS)


def test_forms_of_lines():
    for a, b in (("GENERAL ASSEMBLY    A/70/PV.25", "General Assembly A/3/PV.7"), ("5/PV.399", "S/PV.1"), ("A/63/PV.4 October 2008", "A/1/PV.44 May 1999"), ("0fficial Records    5ecurity Council", "Official Records Security Council"), ("81th meeting - 17 0ctober", "3rd meeting - 1 May")):
        assert line_form(a) == line_form(b), (a, b)
    assert not may_be_header("The General Assembly met.") and not may_be_header("x" * 90) and not may_be_header("")


def test_words():
    assert all(map(may_be_word, ("wi11", "a11", "sha11", "o'kehaf0lski", "c0uncil")))
    assert not any(map(may_be_word, ("12", "1990s", "57th", "a/res/5", "3.5m", "x")))


def test_repair(corpus):
    r = repair("The de1egation of Nusko-\nPage 3\nsuru proposed tbat re- lief\nS/PV.12\nwo­\nrkers sbould be taken up\nfirst. Well-known in the moming they wi11 say what a11 can see", corpus)
    assert sorted(r.hyphens) == ["nuskosuru", "relief", "workers"]
    assert sorted(r.misread) == ["all", "delegation", "morning", "should", "that", "will"]
    assert (r.headers, r.pages) == (1, 1)
    assert readable(r.text) == "The delegation of Nuskosuru proposed that relief workers should be taken up first. Well-known in the morning they will say what all can see"


def test_lists_of_numbers_stay(corpus):
    assert repair("the delegation\n12\nof the session", corpus).pages == 1
    r = repair("the delegation\n12\n13\n14\nof the session", corpus)
    assert r.pages == 0 and readable(r.text) == "the delegation 12 13 14 of the session"


def test_clean_text_stays(corpus):
    for t in (CLEAN.strip(), "We count 3 - 4 such cases a year.", "12", "", None, "the 57th meeting A/RES/5/1 x"):
        r = repair(t, corpus)
        assert (r.hyphens, r.misread, r.headers, r.pages) == ([], [], 0, 0) and r.text == (t or "")


def test_many_words_give_no_false_known_word():
    n = 3_000_000
    table = Counts(np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, n), np.full(n, 3))
    assert not any(table.of(key_of(f"unseen{k}")) for k in range(20_000))


def pages(n):
    """Texts of pages with headers of changing numbers, and one word in some misread."""
    r = random.Random(4)
    words = CLEAN.lower().replace(".", "").split()
    out = []
    for k in range(n):
        body = [r.choice(words) for _ in range(60)]
        if k % 3 == 0:
            body = [w.replace("o", "0", 1) if r.random() < 0.05 and len(w) > 3 else w for w in body]
        lines = [" ".join(body[i : i + 10]) for i in range(0, 60, 10)]
        lines[4:5] = [lines[4] + " thus", "as was said before in this hall", "and so forth " + lines[5]]  # a line that recurs between the same words
        if k % 4 == 0:
            lines[3:3] = [f"Annual Record {k} - May {1990 + k % 9}"]
        if k % 5 == 0:
            lines[2:2] = [f"- {k} -"]
        out.append((k, "\n".join(lines)))
    return out


def test_what_is_learned(spark):
    texts = pages(300)
    df = spark.createDataFrame(texts, "id long, text string").repartition(5)
    c = corpus_of(df)
    assert c.headers == {"annual record # - @ #", "- # -"}
    words = Counter(w.lower().strip(".,;:()[]{}\"'“”‘’«»*?…") for _, t in texts for w in t.split())
    assert all(c.count(w) == (n if n >= 3 else 0) for w, n in words.items() if w) and c.total == sum(n for w, n in words.items() if w)
    assert c.channel["0", "o"] > c.channel["rn", "m"] and math.exp(c.channel["0", "o"]) > 1 / 200
    rows = {r.speech_id: r for r in repaired_texts(df, c).collect()}
    found = {r.speech_id: (r.hyphens, r.misread) for r in repaired_texts(df, c, texts=False).collect()}
    assert found == {k: (r.hyphens, r.misread) for k, r in rows.items() if r.hyphens or r.misread or r.headers or r.pages}
    assert all((rows[k].headers, rows[k].pages) == (int(k % 4 == 0), int(k % 5 == 0)) for k, _ in texts)
    assert all("0" not in rows[k].text for k, _ in texts if k % 3 == 0)


def test_frame(spark):
    rows = [(1, CLEAN * 50, "clash"), (2, "re- lief", "clash"), (3, None, None), (4, "", None), (2, "re- lief", "clash"), (5, "Mr. Baro: One re- lief.\nMs. Rado: Two.", None)]
    df = spark.createDataFrame(rows, "id long, text string, hyphens string")
    got = sorted((r.speech_id, r.text, list(r.hyphens)) for r in repaired_texts(df, corpus_of(df)).collect() if r.speech_id != 1 and r.text is not None)
    assert got == [(2, "relief", ["relief"]), (2, "relief", ["relief"]), (4, "", []), (5, "Mr. Baro: One re- lief.\nMs. Rado: Two.", [])]
    assert repaired_texts(df.where("false"), corpus_of(df.where("false"))).count() == 0
