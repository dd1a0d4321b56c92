import random

import numpy as np
import pytest

from rostrum.llm import leaks
from rostrum.llm.leaks import SEED, Items, Suffixes, apart, chain, find_leaks, longest, search


def random_case(r):
    texts = [" ".join(r.choice("abcd") for _ in range(r.randrange(0, 14))) for _ in range(4)]
    test = Items(list(enumerate(texts)))
    words = [r.choice("abcdx") for _ in range(60)]
    return texts, test, words, np.array([test.vocabulary.get(w, 0) for w in words] + [0], dtype=np.int64)


def common(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_search_equals_brute_force():
    r = random.Random(3)
    for _ in range(60):
        texts, test, words, codes = random_case(r)
        suffix, match, both, places = search(codes, test)
        n = both.common(suffix, match) + 1
        got = sorted((int(test.item[s]), int(test.at[s]), int(places[m]), int(k)) for s, m, k in zip(suffix, match, n))
        want = sorted((i, k, p, x) for i, t in enumerate(texts) for k in range(len(t.split()) - 1) for p in range(len(words) - 1) if (x := common(t.split()[k:], words[p:])) >= SEED)
        assert got == want


def longest_holds(array=None):
    r = random.Random(5)
    for _ in range(40):
        texts, test, words, codes = random_case(r)
        for (n, p), i, k in zip(longest(codes, test), test.item, test.at):
            t = texts[i].split()[k:]
            best = max((common(t, words[q:]) for q in range(len(words))), default=0)
            if n != (best if best >= SEED else 0) or n and common(t, words[p:]) != n:
                return False
    return True


def test_longest_matches_need_the_order_of_suffixes(monkeypatch):
    assert longest_holds()
    shuffled = lambda self, among: np.random.default_rng(0).permutation(among)
    monkeypatch.setattr(Suffixes, "order", shuffled)
    with pytest.raises((AssertionError, ValueError)):
        assert longest_holds()


def test_suffix_array_is_sorted():
    r = np.random.default_rng(1)
    symbols = r.integers(1, 4, 300)
    places = np.concatenate([np.arange(200), np.arange(250, 350)])  # two runs
    array = Suffixes(places, symbols).order(np.arange(300))
    keys = [tuple(symbols[p : 200 if p < 200 else 300]) for p in array]
    assert keys == sorted(keys) and sorted(array) == list(range(300))


def test_chain_keeps_order_and_gap():
    assert chain([(0, 100, 4), (10, 120, 3)])[0] == 7
    assert chain([(10, 100, 3), (0, 120, 3)])[0] == 3
    assert chain([(0, 100, 3), (10, 500, 3)])[0] == 3
    assert chain([(0, 100, 5), (4, 103, 4)])[0] == 7
    assert apart([(0, 100, 6)], {102}) == [(0, 100, 2), (3, 103, 3)]


def test_leaks_of_all_kinds(spark, monkeypatch):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    items = [(k, [word() for _ in range(40)]) for k in range(1, 5)]
    other = lambda n: [word() for _ in range(n)]
    a, b = items[0][1], items[1][1]
    changed = [word() if k % 6 == 5 else w for k, w in enumerate(a)]
    third = [word() if k % 3 == 2 else w for k, w in enumerate(a)]
    docs = [
        (1, " ".join(other(50) + a + other(50))),
        (2, ("... " + "\n".join(changed)).upper()),
        (3, " ".join(a[:25])),
        (4, " ".join(a[:12] + other(90))),
        (5, " ".join(a[:20] + other(15) + a[20:] + b)),
        (6, " ".join(a[20:] + a[:15])),
        (12, " ".join(other(30) + third + other(30))),
        (7, None), (8, ""), (9, "  \n"),
        (10, " ".join(other(20000) + b + other(20000))),
        (1, " ".join(other(50) + a + other(50))),
    ]
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, text string, item_id string")
    i = spark.createDataFrame([*[(k, " ".join(w)) for k, w in items], (9, None), (10, ""), (11, "one")], "item_id long, text string")
    got = sorted((x.doc_id, x.item_id) for x in find_leaks(d, i).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (5, 1), (5, 2), (6, 1), (10, 2), (12, 1)]
    monkeypatch.setattr(leaks, "SHARD_WORDS", 60)  # shards of a text or two
    assert sorted((x.doc_id, x.item_id) for x in find_leaks(d, i).collect()) == got
    assert find_leaks(d.where("false"), i).count() == 0 and find_leaks(d, i.where("false")).count() == 0
