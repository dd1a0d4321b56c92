import random
from itertools import combinations

from rostrum.llm.names import allowed, link_names, parse_name, segment_join, short_forms
from rostrum.llm.strings import within

GIVEN, MIDDLE = frozenset(("vasily", "susannah", "charles", "jose")), frozenset(("noor",))
NICK = {"vasya": ("vasily",), "sue": ("susannah",)}


def test_parsing():
    for name, want in {
        "Vasily Noor Hanoueda": ("full", "vasily", "noor", "hanoueda"),
        "H.E. Mr. HANOUEDA  Vasily": ("full", "vasily", "", "hanoueda"),
        "Hanoueda, Vasily N.": ("full", "vasily", "n", "hanoueda"),
        "Vasliy O'Hanou- eda": ("full", "vasily", "", "ohanoueda"),
        "V.N. Hanoueda": ("short", "v", "n", "hanoueda"),
        "HANOUEDA, V.": ("short", "v", "", "hanoueda"),
        "Vasya van Hanoueda": ("short", "vasya", "", "vanhanoueda"),
        "Dr. HANOUEDA": ("bare", "", "", "hanoueda"),
    }.items():
        assert parse_name(name, GIVEN, MIDDLE, frozenset(NICK)) == (name, *want), name
    assert parse_name("THE PRESIDENT", GIVEN, MIDDLE) is None and parse_name("  ", GIVEN, MIDDLE) is None


def test_segment_join_equals_brute_force(spark):
    r = random.Random(9)
    words = ["".join(r.choice("ab") for _ in range(r.randrange(1, 12))) for _ in range(120)] + ["".join(r.choice("abcd") for _ in range(r.randrange(6, 12))) for _ in range(120)]
    for w in words[:]:  # neighbours by exchanges, which may lie at the borders of segments
        for _ in range(2):
            k = r.randrange(len(w))
            w = w[:k] + w[k + 1 : k + 2] + w[k : k + 1] + w[k + 2 :]
        words.append(w)
    words = sorted(set(words))
    block = {w: "x" if k % 3 else "y" for k, w in enumerate(words)}
    left = spark.createDataFrame([(block[w], w, 7 + k % 2, "l") for k, w in enumerate(words)] + [("x", None, 7, "l")], "block string, a string, short int, l string")
    right = spark.createDataFrame([(block[w], w, "r") for w in words] + [("x", None, "r")], "block string, b string, r string")
    rows = segment_join(left, right).collect()
    got = {(x.a, x.b): x.d for x in rows}
    want = {}
    for k, a in enumerate(words):
        for b in words:
            if block[a] == block[b] and (d := within(a, b, allowed(min(len(a), len(b)), 7 + k % 2, 2))) is not None:
                want[a, b] = d
    assert len(rows) == len(got) and got == want and len(want) > 2 * len(words)
    assert segment_join(left.where("false"), right).isEmpty() and segment_join(left, right.where("false")).isEmpty()


def test_short_forms_are_learned(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("bdfgklmnprst") + r.choice("aeiou") for _ in range(4)).title()
    names = []
    for k in range(300):
        g, s = r.choice(("Robert", "Peter", "Margaret", "Wilhelmina", "Amina")), word()
        names.append(f"{g} {s}")
        short = {"Robert": "Bob", "Margaret": "Peggy", "Wilhelmina": "Mina", "Amina": "Mina"}.get(g)
        if short and k % 4 == 0:
            names.append(f"{short} {s}")
        if k % 10 == 0:  # relatives
            names.append(f"{r.choice(('Robert', 'Peter', 'Margaret'))} {s}")
    df = spark.createDataFrame([(n,) for n in set(names)], "name string")
    assert short_forms(df, frozenset(), len(names)) == {"bob": ("robert",), "peggy": ("margaret",), "mina": ("amina", "wilhelmina")}
    assert short_forms(df.where("false"), frozenset(), 0) == {}


def test_linking(spark):
    others = [(f"{g} {s}", 3) for g in ("Vasily", "Susannah", "Charles", "José") for s in ("Tarbolin", "Melkuras", "Zodomik", "Perrandu", "Sustefan")]
    names = [
        ("Vasily Hanoueda", 9), ("Vasily\xa0Hanoueda", 2), ("HANOUEDA, V.", 1), ("Vasya Hanoueda", 2), ("Vasily Hanuoeda", 1), ("Hánöüéda, Vasily", 1),
        ("Susannah Hanoueda", 5), ("S. Hanoueda", 1), ("Hanoueda", 4),
        ("Charles Yepkiradun", 6), ("Yepkiradun", 1), ("C. Yepkirdun", 1), ("Sue Perrandu", 1),
        ("The President", 50), (None, 3), ("", 2), ("?", 1), ("x" * 3000, 1),
    ]
    df = spark.createDataFrame([(*x, "clash") for x in names + others + names[:2]], "name string, n long, person string")
    by = {}
    for r in link_names(df, share=0.1, nicknames=NICK).collect():
        assert r["name"] not in {n for v in by.values() for n in v}
        by.setdefault(r["person"], set()).add(r["name"])
    groups = [v for v in by.values() if len(v) > 1]
    assert {"Vasily Hanoueda", "Vasily\xa0Hanoueda", "HANOUEDA, V.", "Vasya Hanoueda", "Vasily Hanuoeda", "Hánöüéda, Vasily"} in groups
    assert {"Susannah Hanoueda", "S. Hanoueda"} in groups
    assert {"Charles Yepkiradun", "Yepkiradun", "C. Yepkirdun"} in groups
    assert {"Susannah Perrandu", "Sue Perrandu"} in groups
    assert len(groups) == 4
    assert link_names(df.where("false")).count() == 0
