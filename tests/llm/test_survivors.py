from datetime import date, datetime

from rostrum.llm.survivors import COUNTRY_FIELDS, suppliers, survivors

SCHEMA = "merge_group long, id long, name string, iso3 string, un_member_since date, source string, updated_at timestamp_ntz, trust string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def test_trust_recency_ties_and_nulls(spark):
    t = lambda y: datetime(y, 1, 1)
    rows = [
        (1, 1, "Oldland", "OLD", date(1950, 1, 1), "low", t(2020)),
        (1, 2, "(name to be confirmed)", "XXX", date(2999, 1, 1), "high", t(2021)),
        (1, 3, "Newland", "newl", date(1899, 12, 30), "high", t(2020)),
        (2, 4, "Alone", "ALO", None, "high", t(2020)),
        (3, 5, "A-land", None, None, None, None),
        (3, 6, "B-land", None, None, None, None),
        (3, 6, "B-land", None, None, None, None),
        (None, 7, "Nowhere", "NOW", None, "high", t(2020)),
        (4, 8, "Tie", "TIE", None, "low", t(2020)),
        (4, 9, "Tie", None, None, "low", t(2020)),
    ]
    sources = spark.createDataFrame([("high", 5), ("low", 1)], "source string, trust int")
    df = frame(spark, rows)
    found = suppliers(df, sources, "merge_group", "id", COUNTRY_FIELDS)
    got = {(r.merge_group, r.field, r.id) for r in found.collect()}
    assert got == {(1, "name", 3), (1, "iso3", 1), (1, "un_member_since", 1), (3, "name", 5), (4, "name", 8), (4, "iso3", 8)}
    best = {r.merge_group: (r.name, r.iso3) for r in survivors(df, found, "merge_group", "id", COUNTRY_FIELDS).collect()}
    assert best == {1: ("Newland", "OLD"), 3: ("A-land", None), 4: ("Tie", "TIE")}
    assert suppliers(df.where("false"), sources, "merge_group", "id", COUNTRY_FIELDS).count() == 0
