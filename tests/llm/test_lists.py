import random

import pytest

from rostrum.llm import lists
from rostrum.llm.lists import StateForms, category_forms, forms_of_states, map_to_list, pairs
from rostrum.llm.setjoin import set_join
from rostrum.llm.strings import within


def test_set_join_equals_brute_force(spark):
    r = random.Random(5)
    letters = "abcdefghij"
    make = lambda n: [(i, [r.choice(letters) + r.choice(letters[:3]) for _ in range(r.randrange(0, 9))]) for i in range(n)]
    a, b = make(60), make(40)
    for t in (0.2, 0.5, 0.8, 1.0):
        want = {(i, j) for i, x in a for j, y in b if x and y and len({*x} & {*y}) / len({*x} | {*y}) >= t - 1e-9}
        got = [tuple(p)[:2] for p in set_join(spark.createDataFrame(a, "left int, tokens array<string>"), spark.createDataFrame(b, "right int, tokens array<string>"), t).collect()]
        assert len(got) == len({*got}) and {*got} == want


def test_banded_distance_equals_full():
    def full(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    r = random.Random(7)
    for _ in range(1500):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(0, 9))) for _ in range(2))
        for k in range(4):
            assert within(a, b, k) == (full(a, b) if full(a, b) <= k else None)


def test_values_of_all_kinds(spark):
    entries = spark.createDataFrame([("Republic of Lemira", 1), ("Lemira", 1), ("Democratic Republic of Sonuru", 2), ("Republic of Sonuru", 3), ("North Sastan", 4), ("South Sastan", 5), ("LEM", 1), (None, 9), ("Democratic Republic of Viro", 6), ("Democratic Republic of Kanua", 7), ("United Islands of Bor", 8), ("United Islands of Tim", 10), ("United Islands of Zed", 11)], "value string, ref_id long")
    want = {
        "Rep. of Lemira": 1, "LEMIRÁ": 1, "lem": 1, "Lem- ira": 1, "Lemria": 1, "Dem. Rep. of Sonuru": 2, "Sonuru, Republic of": 3, "N. Sastan": 4, "the South Sastam": 5,
        "Utd. Isl. of Bor": 8, "U.I. of Tim": 10, "delegation of Vi- ro": 6, "Kanua, Dem Rep of": 7,
        "": 0, "?": 0, "Sastan": 0, "Council of Ports": 0, "x" * 5000: 0,
    }
    records = spark.createDataFrame([(v, "clash") for v in [*want, *want, None]], "value string, ref_id string")
    state_forms = forms_of_states(entries)
    got = {r["value"]: r["ref_id"] for r in map_to_list(records, entries, state_forms).collect()}
    assert got == want
    assert map_to_list(records.where("false"), entries, state_forms).count() == 0
    assert {r["ref_id"] for r in map_to_list(records, entries.where("false"), state_forms).collect()} == {0}


def test_generic_words_are_learned(monkeypatch, spark):
    names = [(k, f"{a} {n}") for k, (a, n) in enumerate([("Union of", "Aro"), ("Union of", "Bero"), ("Grand Union of", "Cero"), ("Grand Duchy of", "Dero"), ("Grand Duchy of", "Ero"), ("Duchy of", "Fero")])]
    f = StateForms(names)
    assert set(f.kinds) == {"union", "grand", "duchy"}
    assert f("Gd. Un. of Cero") == f("Grand Union of Cero") == f("Cero (Grnad Unoin of)") == f("G.U. Cero") == [("cero", "", ["grand", "union"])]
    assert StateForms([])("Union of Aro") == [("unionaro", "", [])] and f("") == f("?!") == []
    monkeypatch.setattr(lists, "MOST_ENTRIES", 3)
    with pytest.raises(ValueError):
        forms_of_states(spark.createDataFrame([(str(k), k) for k in range(5)], "value string, ref_id long"))


def test_other_words_for_categories(spark):
    entries = spark.createDataFrame([("Atomic matters", 1), ("Trade matters", 2), ("Refugee protection", 3), ("Public health", 4), (None, 5)], "value string, ref_id long")
    want = {"atomic questions": 1, "protection of refugees": 3, "health matters": 4, "world trade": 2, "other matters": 0, "trade and health": 2, "refugees and health": 0, "": 0, "weather": 0}
    records = spark.createDataFrame([(v,) for v in [*want, None]], "value string")
    got = {r["value"]: r["ref_id"] for r in map_to_list(records, entries, category_forms, by_stems=0.2).collect()}
    assert got == want
    assert {r["ref_id"] for r in map_to_list(records, entries.where("false"), category_forms, by_stems=0.2).collect()} == {0}


def test_categories(spark):
    entries = spark.createDataFrame([("Trade and tariffs", 1), ("Trad and tari", 1), ("Public health", 2)], "value string, ref_id long")
    values = ["Trad. and tari.", "tariffs, Trade and", "[Public helath]", "cat: Public health", "Lunch"]
    got = {r["value"]: r["ref_id"] for r in map_to_list(spark.createDataFrame([(v,) for v in values], "value string"), entries, category_forms).collect()}
    assert got == dict(zip(values, (1, 1, 2, 2, 0)))
    assert len({*pairs("aaaa")}) == 5
