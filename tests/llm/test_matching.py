import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from rostrum.llm.matching import address_likeness, address_words, date_likeness, debate_matches, matches, veto_matches


def test_mixture_finds_planted_matches(spark):
    r = random.Random(1)
    rows, want = [], set()
    for e in range(300):
        for k in range(4):
            good = k == 0 and e % 3 > 0
            x = [min(1.0, max(0.0, r.gauss(0.9 if good else 0.3, 0.12))) for _ in range(3)]
            if r.random() < 0.2:
                x[r.randrange(3)] = None
            rows.append((e, e * 10 + k, *x))
            if good:
                want.add((e, e * 10 + k))
    rows += [(e, t + 5, *x) for e, t, *x in rows if t % 10 == 0]  # repeated targets with new ids
    df = spark.createDataFrame(rows, "entry long, target long, a double, b double, c double")
    start = F.when(F.coalesce("a", F.lit(0.5)) + F.coalesce("b", F.lit(0.5)) + F.coalesce("c", F.lit(0.5)) > 2.2, 0.9).otherwise(0.1)
    got = {(m["entry"], m["target"]): m["confidence"] for m in matches(df, "entry", "target", ["a", "b", "c"], start).collect()}
    assert len({e for e, _ in got}) == len(got)
    assert len(want & {*got}) / len(want) > 0.95 and len(want & {*got}) / len(got) > 0.95
    assert all(0.25 <= p <= 0.5 for p in got.values())  # two targets alike share the posterior
    alone = matches(df.where("target % 10 != 5"), "entry", "target", ["a", "b", "c"], start).collect()
    assert all(0.5 <= m["confidence"] <= 1 for m in alone) and len(want & {(m["entry"], m["target"]) for m in alone}) / len(want) > 0.95
    assert matches(df.where("false"), "entry", "target", ["a", "b", "c"], start).count() == 0


def test_dates(spark):
    day = date(2001, 12, 3)
    others = [day, day + timedelta(1), date(2001, 3, 12), date(2002, 12, 3), date(1980, 1, 1), None]
    df = spark.createDataFrame([(day, x) for x in others], "a date, b date")
    assert [r[0] for r in df.select(date_likeness(F.col("a"), F.col("b"))).collect()] == [1.0, 0.92, 0.8, 0.8, 0.0, None]


def test_address_words(spark):
    texts = [(k, f"Here I greet this house. Matter {'abcdefg'[k % 7] * 3} calls for care." if k < 40 else f"Matter {'abcdefg'[k % 7] * 3} calls for care.") for k in range(400)] + [(900, None), (901, "")]
    speeches = spark.createDataFrame(texts, "target_id long, text string")
    weights = address_words(speeches, spark.createDataFrame([(k,) for k in range(30)] + [(900,)], "target_id long"), bound=25)
    assert {*weights} == {"here", "i", "greet", "this", "house."}
    likely = address_likeness(weights)
    got = dict(speeches.select("target_id", likely("text")).collect())
    assert all((p > 0.9) == (k < 40) for k, p in got.items())
    assert address_words(speeches, speeches.select("target_id").where("false")) == {} == address_words(speeches.where("false"), speeches.select("target_id"))


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_tables(spark, tmp_path):
    sf = str(tmp_path)
    first = date(1990, 9, 20)
    given, surnames = ("Vasily", "Susannah", "Charles", "Amina"), ("Tarbolin", "Melkuras", "Zodomik", "Perrandu", "Sustefan", "Hanoueda")
    docs, speeches, entries, vetoes = [], [], [], []
    person = "struct<name:string,country:string>"
    for k in range(24):
        name, day = f"{given[k % 4]} {surnames[k // 4]}", first + timedelta(k * 3)
        docs.append((k + 1, f"A/45/PV.{k + 1}", "GA", 45, day, None, 1))
        speeches.append((k + 1, k + 1, (name, "Lemira"), "It is an honour to address the general debate. We agree."))
        speeches.append((k + 101, k + 1, (name, "Lemira"), "We have nothing to add at this stage of the debate in the hall."))
        if k % 4:
            entries.append((k + 1, 1, name.upper() if k % 3 else name, 45 if k % 5 else 46, None if k % 7 == 1 and k % 5 else day))
    docs += [(200 + k, f"S/PV.{1000 + 37 * k}", "SC", None, first + timedelta(9 * k), f"Question of item {k}", 1) for k in range(20)]
    for k in range(20):
        typed = ("S/PV.{}", "{}", "s/pv. {}", "{}th meeting")[k % 4].format(1000 + 37 * k)
        vetoes.append((k, first + timedelta(9 * k), typed if k < 17 else None, f"QUESTION OF ITEM {k}"))
    vetoes += [(50, date(1970, 1, 1), "S/PV.39594", "Question of nothing"), (51, None, None, None)]
    entries += [(90, None, "The President", 45, None), (91, 1, "Never Recorded", 45, first)]
    write(spark, sf, "documents", docs, "doc_id long, symbol string, body string, session int, date date, title string, instalment long")
    write(spark, sf, "speeches", speeches, f"id long, document_id long, speaker {person}, text string")
    write(spark, sf, "general_debate_entries", entries, "id long, country_id long, speaker_name string, ga_session int, meeting_date date")
    write(spark, sf, "sc_representatives", [(1, "Vasily Tarbolin")], "id long, name string")
    write(spark, sf, "vetoes", vetoes, "dppa_id long, date date, meeting_symbol string, agenda string")
    write(spark, sf, "member_states", [(1, "Republic of Lemira", "LEM", "Lemira", None)], "state_id long, member_state string, iso_code string, other_names string, earlier_name string")
    got = {(r.entry_id, r.target_id) for r in debate_matches(spark, sf).collect()}
    assert got == {(e[0], e[0]) for e in entries if e[0] < 90}
    got = {(r.entry_id, r.target_id) for r in veto_matches(spark, sf).collect()}
    assert got == {(k, 200 + k) for k in range(20)}


def test_numbers_of_seven_figures(spark, tmp_path):
    sf, first = str(tmp_path), date(1990, 1, 1)
    docs = [(k, f"S/PV.{1234567 + 37 * k}", "SC", first + timedelta(k // 4), f"Question of item {k}", 1) for k in range(80)]
    typed = ("S/PV.{}", "{}", None, "{}th meeting")
    vetoes = [(k, None if k % 3 else first + timedelta(k // 4), (typed[k % 4] or "").format(1234567 + 37 * k) or None, f"Question of item {k}; meeting {1234567 + 37 * k}" if k % 4 == 2 else None) for k in range(60)]
    write(spark, sf, "documents", docs, "doc_id long, symbol string, body string, date date, title string, instalment long")
    write(spark, sf, "vetoes", vetoes, "dppa_id long, date date, meeting_symbol string, agenda string")
    assert {(r.entry_id, r.target_id) for r in veto_matches(spark, sf).collect()} == {(k, k) for k in range(60)}


def test_initials_of_several_persons(spark, tmp_path):
    """An initial that several persons may bear is matched by surname and day where the session is missing."""
    sf, first = str(tmp_path), date(1990, 9, 20)
    given, surnames = ("Vasily", "Viktor", "Charles", "Amina"), ("Tarbolin", "Melkuras", "Zodomik", "Perrandu", "Sustefan", "Hanoueda")
    docs, speeches, entries = [], [], []
    for k in range(24):
        name, day = f"{given[k % 4]} {surnames[k // 4]}", first + timedelta(k * 9)
        docs.append((k + 1, f"A/45/PV.{k + 1}", 45, day))
        speeches.append((k + 1, k + 1, (name, "Lemira"), "It is an honour to address the general debate. We agree."))
        docs.append((k + 101, f"S/PV.{k + 1}", 45, day + timedelta(400)))
        speeches.append((k + 101, k + 101, (name, "Lemira"), "We have nothing to add at this stage of the debate in the hall."))
        entries.append((k + 1, 1, f"V. {surnames[k // 4]}" if k % 4 == 0 else name, None if k % 4 == 0 else 45, day))
    write(spark, sf, "documents", docs, "doc_id long, symbol string, session int, date date")
    write(spark, sf, "speeches", speeches, "id long, document_id long, speaker struct<name:string,country:string>, text string")
    write(spark, sf, "general_debate_entries", entries, "id long, country_id long, speaker_name string, ga_session int, meeting_date date")
    write(spark, sf, "sc_representatives", [(1, "Vasily Tarbolin")], "id long, name string")
    write(spark, sf, "member_states", [(1, "Republic of Lemira", "LEM", "Lemira", None)], "state_id long, member_state string, iso_code string, other_names string, earlier_name string")
    assert {(r.entry_id, r.target_id) for r in debate_matches(spark, sf).collect()} == {(k, k) for k in range(1, 25)}
