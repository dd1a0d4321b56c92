"""Operators on small tables with known results."""

import io
import random
import tarfile
import zipfile
from datetime import date, datetime
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from rostrum.operators import merge, sections, sequences, upsert
from rostrum.operators.graph import climb, components, network_stats, pagerank_rounds, ranked_components
from rostrum.operators.models import bayesian_points, ideal_points, vote_scores
from rostrum.operators.orphans import Reference, Table, cascade
from rostrum.operators.pairs import agreement, pairs_in_group
from rostrum.runtime import hot_keys, join_hot


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda r: [(x is not None, x if isinstance(x, int | float) else 0, str(x)) for x in r])


def test_hot_join_equals_plain_join(spark):
    left = spark.createDataFrame([(1, k) for k in range(900)] + [(k % 300 + 2, k) for k in range(900)] + [(None, -1), (999, -2)], "key long, x long")
    right = spark.createDataFrame([(k, k * 10) for k in range(1, 250)], "key long, y long")
    assert hot_keys(left, "key") == [1]
    for how in ("left", "inner"):
        assert sorted(map(str, rows(join_hot(left, right, "key", how), "key", "x", "y"))) == sorted(map(str, rows(left.join(right, "key", how), "key", "x", "y")))


def test_pairs_equal_self_join(spark):
    r = random.Random(1)
    data = [(v, c, r.choice(("yes", "no", "abstain", "absent"))) for v in range(30) for c in range(8) if r.random() < 0.7]
    df = spark.createDataFrame([(v, 2000 + v % 2, c, p) for v, c, p in data], "vote_id int, yr int, country_id int, vote_position string")
    got = {(x.country_id_a, x.country_id_b, x.yr): (round(x.agreement_rate, 9), x.n_votes) for x in agreement(df, least=1).collect()}
    want = {}
    for v in range(30):
        cast = sorted((c, p) for w, c, p in data if w == v and p != "absent")
        for (a, p), (b, q) in combinations(cast, 2):
            s, n = want.get((a, b, 2000 + v % 2), (0, 0))
            want[a, b, 2000 + v % 2] = (s + (p == q), n + 1)
    assert got == {k: (round(s / n, 9), n) for k, (s, n) in want.items()}
    assert pairs_in_group(df.where("false"), ["vote_id"], "country_id").count() == 0


def test_components_of_paths_and_random_graphs(spark):
    r = random.Random(2)
    edges = [(1, k, k + 1) for k in range(60)] + [(2, r.randrange(80), r.randrange(80)) for _ in range(50)] + [(1, 70, None)]
    nodes = [(1, k) for k in range(75)] + [(2, k) for k in range(80)]
    found = components(spark.createDataFrame(nodes, "yr int, node int"), spark.createDataFrame(edges, "yr int, a int, b int"), ["yr"])
    got = {(x.yr, x.node): x.component for x in found.collect()}
    parent = {k: k for k in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for y, a, b in edges:
        if b is not None:
            u, v = sorted((root((y, a)), root((y, b))))
            parent[v] = u
    assert got == {k: root(k)[1] for k in nodes}
    first = [x.node for x in ranked_components(found, ["yr"]).collect() if x.yr == 1 and x.bloc_index == 0]
    assert sorted(first) == list(range(61))


def test_network(spark):
    star = [(2000, 0, k, 1) for k in range(1, 5)]
    df = spark.createDataFrame(star, "yr int, a int, b int, weight long")
    got = {x.node: x for x in network_stats(df, spark.createDataFrame([(2000, 9), (2001, 1)], "yr int, node int")).collect()}
    assert abs(sum(x.pagerank for x in got.values()) - 1) < 1e-9 and got[0].n_edges == 4 and got[9].n_edges == 0
    assert got[0].betweenness == pytest.approx(12 / 20) and got[1].betweenness == 0
    fixed = {x.node: x.rank for x in pagerank_rounds(df, ["yr"], rounds=60).collect()}
    alone = {x.node: x.pagerank for x in network_stats(df).collect()}
    assert all(fixed[k] == pytest.approx(alone[k], abs=1e-4) for k in fixed)


def test_climbing_with_a_cycle(spark):
    t = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")], "concept string, broader string")
    s = spark.createDataFrame([("c", "root"), ("b", "mid")], "concept string, scheme string")
    assert rows(climb(t, s, 5), "concept", "scheme", "steps") == [("a", "mid", 1), ("b", "mid", 0), ("c", "root", 0)]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 2)], "k int, s string, n int")
    new = spark.createDataFrame([(2, None, 5), (3, "c", 3), (3, "d", 4)], "k int, s string, n int")
    last = F.col("n").desc()
    assert rows(upsert.insert_if_absent(old, new, ["k"], last), "k", "s") == [(1, "a"), (2, "b"), (3, "d")]
    assert {r.k: (r.s, r.n) for r in upsert.overwrite(old, new, ["k"], last).collect()} == {1: ("a", None), 2: (None, 5), 3: ("d", 4)}
    assert {r.k: (r.s, r.n) for r in upsert.merged(old, new, ["k"], {"s": "new", "n": "old"}, last).collect()} == {1: ("a", None), 2: ("b", 2), 3: ("d", 4)}
    assert {r.k: (r.s, r.n) for r in upsert.merged(old, new, ["k"], {"s": "replace", "n": "new"}, last).collect()} == {1: ("a", None), 2: (None, 5), 3: ("d", 4)}
    assert rows(upsert.replace_partitions(old, new, ["k"]), "k") == [(1,), (2,), (3,), (3,)]
    assert rows(upsert.delete_where(old, new, ["k"]), "k") == [(1,)]
    assert rows(upsert.back_fill(old, spark.createDataFrame([(1, 9)], "k int, n int"), ["k"], "n"), "k", "n") == [(1, 9), (2, 2)]
    out = upsert.delete_cascade(old, {"c": (spark.createDataFrame([(1, 1), (2, 2)], "id int, p int"), "p")}, old.where("k = 1"), "k")
    assert rows(out[""], "k") == [(2,)] and rows(out["c"], "id") == [(2,)]
    assert upsert.overwrite(old.where("false"), new.where("false"), ["k"]).count() == 0


def test_partitions_on_disk(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, 2000), (2, 2001)], "v int, yr int")
    for _ in range(2):
        upsert.write_partitions(a, path, ["yr"])
        upsert.write_partitions(spark.createDataFrame([(9, 2001)], "v int, yr int"), path, ["yr"])
        assert rows(spark.read.parquet(path), "v", "yr") == [(1, 2000), (9, 2001)]


def test_merging(spark):
    xref = spark.createDataFrame([(5, 1), (6, 2)], "old_id int, new_id int")
    pairs = spark.createDataFrame([(1, 2, 10), (5, 6, 20), (6, 1, 5), (1, 5, 7)], "a int, b int, n int")
    assert rows(merge.repoint_pairs(pairs, xref, "a", "b", [], F.col("n").desc()), "a", "b", "n") == [(1, 2, 20)]
    good, bad = merge.quarantine(spark.createDataFrame([("FRA",), ("x",), (None,)], "iso3 string"), F.col("iso3").rlike("^[A-Z]{3}$"))
    assert (good.count(), bad.count()) == (1, 2)


def test_sequences(spark):
    df = spark.createDataFrame([(1, k, "x" if k in (0, 3) else None) for k in range(6)], "doc int, seq int, h string")
    assert [r.section_id for r in sequences.sections(df, ["doc"], ["seq"], F.col("h").isNotNull()).orderBy("seq").collect()] == [1, 1, 1, 2, 2, 2]
    assert [len(r.b) for r in sequences.look_back(df, ["doc"], ["seq"], "seq", 2, "b").orderBy("seq").collect()] == [0, 1, 2, 2, 2, 2]
    n = spark.createDataFrame([("A", 1, 10), ("A", 2, 30), ("B", 1, 5)], "m string, t int, n int")
    assert rows(sequences.smooth(n, "m", "t", "n"), "m", "t", "smooth") == [("A", 1, 0.25), ("A", 2, 0.75), ("B", 1, 1.0)]


def test_sections_and_items(spark):
    text = [
        ("GENERAL ASSEMBLY", False, False), ("Agenda item 5 (continued)", True, False), ("The President: I give the floor.", True, False), ("He may speak.", False, False),
        ("Draft resolution (A/64/L.1)", True, False), ("Mr. Baro (Lemira): We agree.", True, False), ("Draft resolution A/64/L.1 was adopted (resolution 64/2).", False, True), ("And more words.", False, False),
        ("Agenda item 6", True, False), ("Nobody speaks.", False, False),
    ]
    b = spark.createDataFrame([("d", k, *x) for k, x in enumerate(text)] + [(None, 0, "x", False, False)], "doc string, seq int, text string, bold_start boolean, all_italic boolean")
    s = sections.sectionise(b)
    assert [r.kind for r in s.orderBy("section_id").collect()] == ["cover", "agenda", "speaker", "draft", "speaker", "stage", "text", "agenda"]
    got = sections.items(s).orderBy("item", F.coalesce("position_in_item", F.lit(-1))).collect()
    assert [(r.item, r.element, r.position_in_item, r.position_in_document) for r in got] == [(1, "item", None, None), (1, "speech", 0, 0), (1, "speech", 1, 1), (1, "direction", 2, 2), (1, "resolution", 3, None), (2, "item", None, None)]
    assert got[2].text.endswith("And more words.") and got[4].draft_symbol == "A/64/L.1" and got[1].speaker == "The President"
    assert (got[4].adopted_symbol, got[4].vote_type, got[4].votes) == ("64/2", "consensus", [])
    assert sections.items(sections.sectionise(b.where("false"))).count() == 0


def test_votes_of_items(spark):
    def resolutions(*text):
        b = spark.createDataFrame([("d", k, *x) for k, x in enumerate(text)], "doc string, seq int, text string, bold_start boolean, all_italic boolean")
        got = sections.items(sections.sectionise(b)).where("element = 'resolution'").orderBy("item", "position_in_item").collect()
        return [(r.draft_symbol, r.vote_type, (r.yes, r.no, r.abstain), [(v.country, v.position) for v in r.votes]) for r in got]

    agenda, president = ("Agenda item 5", True, False), ("The President: We vote on A/64/L.9.", True, False)
    taken = ("A recorded vote was taken.", False, True)
    lists = [("In favour: Chad, Peru", False, False), ("Against: Togo", False, False), ("Abstaining: None", False, False)]
    chad = [("Chad", "yes"), ("Peru", "yes"), ("Togo", "no")]
    adopted = ("Draft resolution A/64/L.1 was adopted by 2 votes to 1.", False, True)
    # before the adoption, after it, and announced by the next speaker
    assert resolutions(agenda, president, taken, *lists, adopted) == [("A/64/L.1", "recorded", (2, 1, 0), chad)]
    assert resolutions(agenda, president, adopted, *lists) == [("A/64/L.1", "recorded", (2, 1, 0), chad)]
    said = ("The President: The draft resolution received 2 votes in favour, one against. The draft resolution has been adopted as resolution 12 (2001).", True, False)
    assert resolutions(agenda, president, taken, *lists, said) == [("A/64/L.9", "recorded", (2, 1, 0), chad)]
    # lists of the vote after it aren't its own; the same draft counts once for each item
    other = ("Draft resolution A/64/L.2 was adopted (resolution 64/3).", False, True)
    assert resolutions(agenda, president, other, taken, *lists, adopted, adopted) == [("A/64/L.2", "consensus", (None, None, None), []), ("A/64/L.1", "recorded", (2, 1, 0), chad)]
    # without a symbol the last heading's draft is meant, within its item only
    heading, short = ("Draft resolution (A/64/L,7)", True, False), ("The draft resolution was adopted.", False, True)
    assert resolutions(agenda, heading, president, short) == [("A/64/L.7", "consensus", (None, None, None), [])]
    assert resolutions(agenda, heading, ("Agenda item 6", True, False), short) == []


def test_page_order(spark):
    one = [("a", 1, 10.0, float(k), 600.0) for k in range(10)]
    two = [("b", 1, 400.0 if k % 2 else 10.0, float(k), 600.0) for k in range(10)]
    df = sections.reading_order(spark.createDataFrame(one + two, "doc string, page_num int, x0 double, y0 double, page_width double"))
    assert [r.y0 for r in df.where("doc = 'a'").orderBy("seq").collect()] == list(range(10))
    assert [r.y0 for r in df.where("doc = 'b'").orderBy("seq").collect()] == [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def test_html(spark):
    from rostrum.sources.html import html_blocks, parse

    page = "<head><title>t</title></head><p><b>Mr. X</b> says &amp; more</p><script>no</script><div style='font-weight: 700'>bold<span> still</span></div><p>plain</p><p><em>all</em></p>"
    assert [[(x["text"], x["bold"], x["italic"]) for x in b] for b in parse(page)] == [[("Mr. X", True, False), (" says & more", False, False)], [("bold", True, False), (" still", True, False)], [("plain", False, False)], [("all", False, True)]]
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<p>one</p>")], "id int, html string")
    assert rows(html_blocks(df, "id", "html", least=2).groupBy("id").count()) == [(1, 4)]


def test_orphan_cascade(spark):
    t = lambda y: datetime(y, 1, 1)
    tables = {
        "a": Table(spark.createDataFrame([(1, t(2000), None), (2, t(2010), None), (3, t(2000), t(2001))], "id int, loaded_at timestamp_ntz, gone timestamp_ntz"), deleted="gone"),
        "b": Table(spark.createDataFrame([(10, 1, t(2005)), (11, 9, t(2005)), (12, 2, t(2005)), (13, 3, t(2005)), (14, None, t(2005))], "id int, a int, loaded_at timestamp_ntz")),
        "c": Table(spark.createDataFrame([(20, 10, t(2006)), (21, 11, t(2006)), (22, 12, t(2006)), (23, 13, t(2006)), (23, 13, t(2006))], "id int, b int, loaded_at timestamp_ntz")),
    }
    refs = [Reference("b", "a", F.col("a")), Reference("c", "b", F.col("b"))]
    got = rows(cascade(tables, refs), "ref_table", "ref_id", "kind", "level")
    assert got == [("b", 11, "missing", 0), ("b", 12, "late", 0), ("b", 13, "deleted", 0), ("c", 21, "inherited", 1), ("c", 23, "inherited", 1)]


def test_ideal_points_find_the_order(spark):
    r = random.Random(3)
    place = {c: -1.5 + 3 * c / 11 for c in range(12)}
    cast = [(2000, c, v, "yes" if place[c] * (1 if v % 2 else -1) + r.gauss(0, 0.4) > r.uniform(-1, 1) * 0.6 else "no") for v in range(120) for c in place]
    df = spark.createDataFrame(cast, "yr int, country_id int, vote_id int, vote_position string")
    for found in (ideal_points(df), bayesian_points(df, rounds=60, burn=40)):
        x = [p.ideal_point for p in sorted(found.collect(), key=lambda p: p.country_id)]
        assert len(x) == 12 and x[0] < 0
        concordant = sum(a < b for a, b in combinations(x, 2)) / 66
        assert concordant > 0.9
    assert ideal_points(df.where("false")).count() == 0


def test_bayesian_points_link_the_years(spark):
    r = random.Random(5)
    place = {c: -1.5 + 3 * c / 11 for c in range(12)}
    cast = [(yr, c, v, "yes" if place[c] * (1 if v % 2 else -1) + r.gauss(0, 0.4) > r.uniform(-1, 1) * 0.6 else "no") for yr in (2000, 2001) for v in range(120) for c in place]
    sparse = [x for x in cast if x[:2] != (2001, 11) or x[2] == 0]  # one ballot of the last member in the second year
    found = bayesian_points(spark.createDataFrame(sparse, "yr int, country_id int, vote_id int, vote_position string"), rounds=200, burn=100, thin=2).collect()
    x = {(p.yr, p.country_id): p.ideal_point for p in found}
    assert len(x) == 24 and x[2000, 11] > 1
    assert abs(x[2001, 11] - x[2000, 11]) < 0.3


def test_bayesian_points_runs_the_reference_sweeps(spark, monkeypatch):
    from rostrum.plans import models

    monkeypatch.setattr(models, "ballots", lambda spark, sf: spark.createDataFrame([(2000, 1, 1, "yes")], "yr int, country_id int, vote_id int, vote_position string"))
    real, seen = models.models.bayesian_points, {}
    defaults = dict(zip(real.__code__.co_varnames[1:], real.__defaults__))
    monkeypatch.setattr(models.models, "bayesian_points", lambda votes, **k: seen.update(defaults | k) or real(votes, **k))
    models.bayesian_points(spark, "")
    assert (seen["rounds"], seen["burn"], seen["thin"]) == (5000, 1000, 10)


def test_bayesian_points_are_sampled_by_many_tasks(spark, monkeypatch):
    from rostrum.operators import models

    r = random.Random(8)
    place = {c: -1.5 + 3 * c / 11 for c in range(12)}
    side = lambda v: 1 if v % 2 else -1
    cast = [(yr, c, v, "yes" if (x := place[c] * side(v) + r.gauss(0, 0.4) - r.uniform(-0.3, 0.3)) < -0.2 else "no" if x > 0.2 else "abstain") for yr in (2000, 2001) for v in range(100) for c in place]
    df = spark.createDataFrame(cast, "yr int, country_id int, vote_id int, vote_position string")
    monkeypatch.setattr(models, "SHARD", 200)
    asked, real, found = [], models.together, []
    monkeypatch.setattr(models, "together", lambda df, part, tasks, f, schema: asked.append(tasks) or real(df, part, tasks, f, schema))
    for most in (1, 3):
        monkeypatch.setattr(models, "slots", lambda df: most)
        found.append({(p.yr, p.country_id): (p.ideal_point, p.se) for p in models.bayesian_points(df, rounds=60, burn=40, thin=2).collect()})
    assert asked == [1, 3] and len(found[0]) == 24
    assert found[0] == found[1]
    x = [found[0][2000, c][0] for c in range(12)]
    assert sum(a < b for a, b in combinations(x, 2)) / 66 > 0.9


def test_normal_law_from_tables():
    import numpy as np

    from rostrum.operators.ordinal import law

    p = np.array([1e-15, 1e-9, 1e-4, 0.009, 0.011, 0.3, 0.5, 0.77, 0.995])
    known = [-7.941345, -5.997807, -3.719016, -2.365618, -2.290368, -0.524401, 0.0, 0.738847, 2.575829]
    assert np.abs(law().ppf(p) - known).max() < 1e-4
    assert np.abs(law().cdf(np.array(known)) - p).max() < 2e-6


def test_vote_scores(spark):
    r = random.Random(4)
    data = []
    for k in range(240):
        x = r.uniform(-1, 1)
        data.append((k, "yes" if x > 0.3 else "no" if x < -0.3 else "abstain", x if k % 9 else None))
    s = vote_scores(spark.createDataFrame(data, "id int, vote string, x double"), "vote", ["x"], iterations=4).collect()
    assert all(abs(p.p_yes + p.p_no + p.p_abstain - 1) < 1e-3 and 0 <= p.anomaly_score <= 1 for p in s)
    assert sum(p.predicted == p.vote for p in s if p.x is not None) / sum(p.x is not None for p in s) > 0.9


def test_boosted_trees_are_those_of_the_distributed_trainer(spark):
    import numpy as np
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from rostrum.operators.boosting import boosted

    r = random.Random(2)
    data = [(k, round(r.gauss(0, 1), 1), float(r.randint(0, 5)), r.uniform(1, 3)) for k in range(200)]
    data = [(*row, float(row[1] + 0.3 * row[2] + r.gauss(0, 0.5) > 1)) for row in data]
    df = VectorAssembler(inputCols=["x", "z"], outputCol="f").transform(spark.createDataFrame(data, "id int, x double, z double, w double, y double").coalesce(1))
    model = GBTClassifier(featuresCol="f", labelCol="y", weightCol="w", maxIter=3, maxDepth=4, maxBins=255, stepSize=0.1, seed=42).fit(df)
    known = [p[0] for p in model.transform(df).orderBy("id").select(vector_to_array("probability")[1]).collect()]
    a = np.array(data)
    assert np.abs(boosted(a[:, 1:3], a[:, 3] * a[:, 4], a[:, 3] * (1 - a[:, 4]), 3, 4, 255, 0.1) - known).max() < 1e-9


def test_vote_scores_train_by_task(spark, monkeypatch):
    from rostrum.operators import models

    r = random.Random(9)
    data = []
    for k in range(400):
        x, z = r.gauss(0, 1), r.randint(0, 5)
        data.append((k, None if k % 50 == 0 else "yes" if x + 0.3 * z > 1 else "no" if r.random() < 0.8 else "abstain", round(x, 1) if k % 9 else None, z))
    df = spark.createDataFrame(data, "id int, vote string, x double, z int")
    seen, found = [], []
    for name in ("_by_task", "_by_spark"):
        monkeypatch.setattr(models, name, lambda *a, name=name, real=getattr(models, name): seen.append(name) or real(*a))
    for most in (10_000, 1):
        monkeypatch.setattr(models, "ONE_TASK", most)
        found.append({p.id: p for p in models.vote_scores(df, "vote", ["x", "z"], iterations=2, depth=3).collect()})
    assert seen == ["_by_task", "_by_spark"] and len(found[0]) == len(found[1]) == 400
    apart = [abs(found[0][k][c] - found[1][k][c]) for k in found[0] for c in ("p_yes", "p_no", "p_abstain")]
    assert sum(apart) / len(apart) < 0.01  # the trainers may choose differently among equally good splits
    assert found[0][0].anomaly_score is None and found[0][0].p_yes is not None


def test_thresholds_of_many_values_share_the_weight():
    import numpy as np

    from rostrum.operators.boosting import thresholds

    assert list(thresholds(np.array([3.0, 1.0, 2.0, 9.0]), np.array([1.0, 1.0, 1.0, 0.0]), 4)) == [1.5, 2.5]
    t = thresholds(np.arange(1000.0), np.ones(1000), 10)
    assert len(t) == 9 and np.abs(np.diff(t) - 100).max() <= 1


def test_vote_anomalies_trains_in_full(spark, monkeypatch):
    from pyspark.ml import classification

    from rostrum.plans import models

    asked = {}

    def stop(**k):
        asked.update(k)
        raise StopIteration

    monkeypatch.setattr(classification, "GBTClassifier", stop)
    read = {"part": "p_partkey int, p_type string", "lineitem": "l_partkey int, l_suppkey int, l_shipdate date", "supplier": "s_suppkey int, s_nationkey int"}
    data = {"part": [(1, "SMALL")], "lineitem": [(1, 7, date(2000, 1, 1)), (1, 8, date(2000, 1, 2)), (1, 9, date(2001, 1, 1))], "supplier": [(7, 1), (8, 4), (9, 3)]}
    monkeypatch.setattr(models, "load", lambda spark, sf, table, *columns: spark.createDataFrame(data[table], read[table]))
    monkeypatch.setattr(models, "ballots", lambda spark, sf: spark.createDataFrame([(1, 1, 2000, "yes"), (2, 1, 2000, "no"), (1, 2, 2000, "no")], "country_id int, vote_id int, yr int, vote_position string"))
    with pytest.raises(StopIteration):
        models.vote_anomalies(spark, "")
    assert (asked["maxIter"], asked["maxDepth"]) == (200, 6)
    got = {(r.country_id, r.vote_id): r for r in models.vote_rows(spark, "").collect()}
    assert len(got) == 3 and len(models.VOTE_FEATURES) == 12
    assert (got[1, 1].n_sponsors, got[1, 1].us_sponsored, got[1, 1].cn_sponsored, got[1, 1].issue_di, got[1, 1].issue_me) == (2, True, False, True, False)
    assert (got[1, 2].n_sponsors, got[1, 2].us_sponsored, got[1, 2].issue_di) == (0, False, None)


def test_topics_pass_over_all_texts(spark, monkeypatch):
    from pyspark.ml import clustering

    from rostrum.plans import models

    asked = {}

    def stop(**k):
        asked.update(k)
        raise StopIteration

    monkeypatch.setattr(clustering, "LDA", stop)
    r = random.Random(6)
    docs = spark.createDataFrame([(i, "en", " ".join("".join(r.choice("xyzwv") for _ in range(3)) for _ in range(40))) for i in range(1100)], "doc_id long, lang string, text string")
    monkeypatch.setattr(models, "load", lambda spark, sf, table, *columns: docs)
    with pytest.raises(StopIteration):
        models.speech_topics(spark, "")
    assert asked["k"] == 50
    assert asked["maxIter"] == 20 * 3 and asked["subsamplingRate"] == 1 / 3  # 20 passes in batches of 512 at most


def test_topics_are_found_by_many_tasks(spark, monkeypatch):
    from rostrum.operators import models

    r = random.Random(7)
    words = ["".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(3)) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(r.choice(words[20 * (i % 3) : 20 * (i % 3) + 20]) for _ in range(40))) for i in range(600)] + [(600, "zzz " * 40)], "doc_id long, text string")
    asked, real = [], models.together
    monkeypatch.setattr(models, "together", lambda df, part, tasks, f, schema: asked.append(tasks) or real(df, part, tasks, f, schema))
    monkeypatch.setattr(models, "TEXTS", 200)
    named, weights = models.topics(docs, "doc_id", "text", k=3, rounds=4, batch=100)
    assert asked == [3]
    of = {w.doc_id: w.topic_num for w in weights.collect() if w.weight > 0.8}
    assert set(of) == set(range(600)) and all(of[i] == of[i % 3] for i in of) and len({of[i] for i in range(3)}) == 3
    for row in named.collect():
        part = next(i for i in range(3) if of[i] == row.topic_num)
        assert len(row.keywords) == 10 and set(row.keywords) <= set(words[20 * part : 20 * part + 20])


def test_archives_and_tables(spark, tmp_path):
    from rostrum.sources import files

    tar, zipped = io.BytesIO(), io.BytesIO()
    with tarfile.open(fileobj=tar, mode="w:gz") as z:
        info = tarfile.TarInfo("x/FRA_12_1957.txt")
        info.size = 5
        z.addfile(info, io.BytesIO(b"hello"))
    with zipfile.ZipFile(zipped, "w") as z:
        z.writestr("S_RES_0242_1967_EN.txt", "text")
    (tmp_path / "a.bin").write_bytes(tar.getvalue())
    (tmp_path / "b.bin").write_bytes(zipped.getvalue())
    m = files.members(files.files(spark, str(tmp_path), "*.bin"), ".txt")
    got = m.select("path", *files.corpus_key(), files.resolution_key(), F.decode("content", "utf-8").alias("text"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("x/FRA_12_1957.txt", "FRA", 12, 1957, None, "hello"), ("S_RES_0242_1967_EN.txt", None, None, None, "S/RES/242(1967)", "text")]))
    (tmp_path / "t.csv").write_text("﻿Name,Other\n\"A, B\",1\n", encoding="utf-8")
    assert rows(files.sniffed_table(spark, str(tmp_path / "t.csv"))) == [("A, B", "1")]
    (tmp_path / "g.graphml").write_text('<graphml><graph><edge source="a" target="b"><data key="e_weight">2</data></edge><edge source="a" target="b"><data key="e_weight">3</data></edge><edge source="a" target="a"/></graph></graphml>')
    assert rows(files.graph_edges(spark, str(tmp_path / "g.graphml"))) == [("a", "b", 5.0)]
    (tmp_path / "s.ttl").write_text('@prefix s: <http://x/> .\n<c1> s:broader <c2> ;\n  s:label "One"@en , "Un"@fr .\n<c2> s:inScheme <root> .\n')
    assert rows(files.triples(spark, str(tmp_path / "s.ttl"))) == [("<c1>", "s:broader", "<c2>"), ("<c1>", "s:label", '"One"@en'), ("<c1>", "s:label", '"Un"@fr'), ("<c2>", "s:inScheme", "<root>")]


def test_meeting_records(spark, tmp_path):
    import json

    from rostrum.sources import files, meetings

    vote = {"draft_symbol": "A/1/L.1", "vote_type": "recorded", "yes_count": 1, "no_count": 1, "abstain_count": 0, "position_in_item": 2, "country_votes": [{"country": "X", "vote_position": "yes"}, {"country": "X", "vote_position": "no"}, {"country": "Y", "vote_position": "no"}]}
    speech = lambda k: {"position": k, "position_in_item": k, "text": "t", "speaker": {"name": "Baro", "country": None}}
    rec = {"symbol": "A/1/PV.1", "body": "GA", "session": 1, "meeting_number": 1, "date": "1950-01-01", "items": [{"position": 0, "item_type": "agenda_item", "title": "T", "continued": False, "speeches": [speech(0), speech(1)], "stage_directions": [], "resolutions": [vote]}]}
    for k in range(2):
        (tmp_path / f"meeting_{k}.json").write_text(json.dumps(rec))
    (tmp_path / "meeting_9.json").write_text("{broken")
    read = files.meetings(spark, str(tmp_path / "meeting_*.json")).cache()
    assert read.where("_corrupt_record is not null").count() == 1
    t = meetings.relational(read)
    assert {k: v.count() for k, v in t.items()} == {"documents": 1, "items": 1, "speakers": 1, "speeches": 2, "directions": 0, "resolutions": 1, "votes": 1, "country_votes": 2}
    assert rows(t["country_votes"], "country", "vote_position") == [("X", "yes"), ("Y", "no")]
    meetings.write_records(read.where("_corrupt_record is null").drop("_corrupt_record"), str(tmp_path / "out"))
    meetings.write_failures(read, str(tmp_path / "failed"))
    assert (tmp_path / "out" / "key=A_1_PV.1").exists() and spark.read.json(str(tmp_path / "failed")).count() == 1


def test_master_merge(spark):
    listed = spark.createDataFrame([("Lemira", "LEM", "Lemira"), ("Rep. of Lemira", "LEM", "Lemira"), ("Sonuru", "SON", "Sonuru"), ("Old Sonuru", "SON", "Sonuru"), ("Grokalique", "GRL", "Grokalique")], "alias string, code string, canonical string")
    r = spark.createDataFrame([
        (1, "Lemira", "LEM"), (2, "REP. OF LEMIRA", None), (3, "Old Sonuru", "SON"), (4, "old sonuru", None), (5, "Grokaliqe", None), (6, "Grokalike", None),
        (7, "put to the vote", None), (8, "abc", None), (9, None, None), (10, "Lemra", None), (11, "Elsewhere", "ELS"),
    ], "id long, name string, code string")
    got = {x["id"]: (x["action"], x["new_id"], x["name"], x["code"]) for x in merge.master_merge(r, listed).collect()}
    assert got == {
        1: ("keep", 1, "Lemira", "LEM"), 2: ("merge", 1, "Lemira", "LEM"), 3: ("rename", 3, "Sonuru", "SON"), 4: ("merge", 3, "Sonuru", "SON"),
        5: ("fuzzy_rename", 5, "Grokalique", "GRL"), 6: ("fuzzy_merge", 5, "Grokalique", "GRL"), 7: ("delete", None, None, None), 8: ("delete", None, None, None),
        9: ("delete", None, None, None), 10: ("fuzzy_merge", 1, "Lemira", "LEM"), 11: ("keep", 11, "Elsewhere", "ELS"),
    }
    assert merge.master_merge(r.where("false"), listed).count() == 0
    assert {x["action"] for x in merge.master_merge(r, listed.where("false")).collect()} == {"keep", "delete"}


def test_streams(spark, tmp_path):
    from rostrum.streaming import incremental as s

    folder, schema = str(tmp_path / "in"), "event_id int, ts timestamp, user_id int, event_type string, value double"
    day = lambda k: datetime(2024, 1, 1, k)
    batch = lambda rows_: spark.createDataFrame(rows_, schema).write.mode("append").parquet(folder)
    sink = s.upserting(spark, str(tmp_path / "state"), ["user_id"], "ts")
    batch([(1, day(1), 1, "a", 1.0), (2, day(2), 1, "a", 1.0), (3, day(1), 2, "b", 1.0)])
    s.run_once(s.incoming(spark, folder, schema), str(tmp_path / "ck"), sink=sink)
    batch([(4, day(3), 2, "b", 1.0), (5, day(3), 3, "b", 1.0)])
    s.run_once(s.incoming(spark, folder, schema), str(tmp_path / "ck"), sink=sink)
    s.run_once(s.incoming(spark, folder, schema), str(tmp_path / "ck"), sink=sink)
    state = str(tmp_path / "state")
    assert rows(s.current_state(spark, state), "user_id", "event_id") == [(1, 2), (2, 4), (3, 5)]
    batch([(6, day(1), 3, "b", 1.0)])  # comes late, changes nothing
    s.run_once(s.incoming(spark, folder, schema), str(tmp_path / "ck"), sink=sink)
    assert rows(s.current_state(spark, state), "user_id", "event_id") == [(1, 2), (2, 4), (3, 5)]
    sink(spark.createDataFrame([(9, day(9), 1, "a", 1.0)], schema), 1)  # batch 1 once more, with other rows: from the state before it
    assert (1, 9) in rows(s.current_state(spark, state, before=2), "user_id", "event_id")
    assert s.current_state(spark, str(tmp_path / "nothing")) is None
    told = s.notifying(str(tmp_path / "told"), "events", "event_id")
    for _ in range(2):
        told(spark.createDataFrame([(9, day(9), 1, "a", 1.0)], schema), 0)
    assert rows(spark.read.json(str(tmp_path / "told" / "0")), "channel", "payload") == [("events", '{"event_id":9}')]
    s.run_once(s.windowed_counts(s.incoming(spark, folder, schema)), str(tmp_path / "ck2"), path=str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w")).where("n > 0").count() >= 1


def test_registry_is_complete(spark):
    import __spark_entry__ as e

    q, sql = e.queries(), e.oracle_sql()
    assert {*sql} <= {*q} and len(q) > 80
    assert e.entry(spark).limit(1).count() == 1


def test_dates_are_kept(spark):
    from rostrum.functions import text as t

    assert spark.createDataFrame([("11/16/45",)], "d string").select(t.short_year_date(F.col("d"))).first()[0] == date(1945, 11, 16)
