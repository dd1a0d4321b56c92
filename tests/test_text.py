"""Functions on text as input and expected output."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rostrum.functions import text as t
from rostrum.functions.symbols import canonical_symbol

CASES = [
    (t.normalize_allcaps, "REPORT OF THE COMMITTEE ON O'NEIL", "Report of the Committee on O'Neil"),
    (t.normalize_allcaps, "Report of the Committee", "Report of the Committee"),
    (t.repair_hyphenation, "Organiza- tion", "Organization"),
    (t.repair_hyphenation, "Declara-\n\ntion on the Establis", "Declaration on the Establis"),
    (t.repair_hyphenation, "Secretary- General", "Secretary- General"),
    (t.repair_hyphenation, "well-known", "well-known"),
    (t.strip_print_codes, "a 08-51481 (E) b\n\n\n\nc", "a  b\n\nc"),
    (t.record_symbol, "Official  A/76/PV.102  Records", "A/76/PV.102"),
    (lambda c: t.session_of(c), "A/64/PV.121", 64),
    (lambda c: t.session_of(c), "S/PV.9453", None),
    (t.ordinal_year, "Seventy-third year", 73),
    (t.ordinal_year, "Seventy third year", 73),
    (t.ordinal_year, "One hundredth year", 100),
    (t.ordinal_year, "of the eleventh year", 11),
    (t.ordinal_year, "Some year", None),
    (t.meeting_number, "9453rd plenary meeting", 9453),
    (t.meeting_number, "S/PV.12", 12),
    (t.spelled_date, "Monday, 13 September 2010, 3 p.m.", dt.date(2010, 9, 13)),
    (t.spelled_date, "1 January 1944", None),
    (t.spelled_date, "31 December 2100", dt.date(2100, 12, 31)),
    (t.spelled_date, "31 February 2001", None),
    (t.spelled_date, "I September 1975", dt.date(1975, 9, 1)),
    (t.any_date, "25/12/2001", dt.date(2001, 12, 25)),
    (t.any_date, "no date", None),
    (t.location, "Meeting held in Geneva", "Geneva"),
    (t.location, "Vienna", None),
    (lambda c: t.speaker_info(c)["country"], "Mr. Dai Bing (China) (spoke in Chinese):", "China"),
    (lambda c: t.speaker_info(c)["language"], "Mr. Dai Bing (China) (spoke in Chinese):", "Chinese"),
    (lambda c: t.speaker_info(c)["language"], "The President (spoke in Arabic):", "Arabic"),
    (lambda c: t.speaker_info(c)["country"], "The President (spoke in Arabic):", None),
    (lambda c: t.speaker_info(c)["role"], "The President (spoke in Arabic):", "President"),
    (lambda c: t.speaker_info(c)["name"], "MRS. PANDIT (India) (spoke in French):", "Pandit"),
    (t.speaker_info, "It was so decided.", None),
    (lambda c: t.split_attribution(c)["attribution"], "1. MR. AHMED (Pakistan): I should like to join", "MR. AHMED (Pakistan)"),
    (lambda c: t.split_attribution(c)["body"], "1. MR. AHMED (Pakistan): I should like to join", "I should like to join"),
    (t.country_list, "Algeria, Angola, Argentina", ["Algeria", "Angola", "Argentina"]),
    (t.sponsor_list, "France, Germany and Spain.", ["France", "Germany", "Spain"]),
    (t.country_list, "Chad, United Kingdom of Great Britain and Northern Ireland", ["Chad", "United Kingdom of Great Britain and Northern Ireland"]),
    (t.country_list, "Chad, United Kingdom of Great Britain and Northern Ireland and United States of America", ["Chad", "United Kingdom of Great Britain and Northern Ireland", "United States of America"]),
    (t.country_list, "Chad, " + "x" * 81, ["Chad"]),
    (lambda c: F.to_json(t.vote_totals(c)), "121 in favour to 5 against, with 3 abstentions", '{"yes":121,"no":5,"abstain":3}'),
    (lambda c: F.to_json(t.vote_totals(c)), "100 in favour to 0 against", '{"yes":100,"no":0,"abstain":0}'),
    (lambda c: F.to_json(t.vote_totals(c)), "received 13 votes in favour, none against and two abstentions", '{"yes":13,"no":0,"abstain":2}'),
    (lambda c: F.to_json(t.vote_totals(c)), "received 13 votes in favour, none against", '{"yes":13,"no":0,"abstain":0}'),
    (lambda c: F.to_json(t.vote_totals(c)), "by 121 votes in favour to 5 against", '{"yes":121,"no":5,"abstain":0}'),
    (lambda c: F.to_json(t.country_votes(c)), "In favour: Chad, Peru.\nAgainst: China and Togo\nAbstaining: None\nDraft resolution I was adopted by 2 votes to 2.\nIn favour: Fiji", '[{"country":"Chad","position":"yes"},{"country":"Peru","position":"yes"},{"country":"China","position":"no"},{"country":"Togo","position":"no"}]'),
    (lambda c: F.to_json(t.country_votes(c)), "The draft resolution was adopted.\nIn favour:\nChad,\nPeru\nAgainst: chad\n[Subsequently Fiji]", '[{"country":"Chad","position":"yes"},{"country":"Peru","position":"yes"}]'),
    (lambda c: F.to_json(t.country_votes(c)), "It was so decided.", "[]"),
    (lambda c: F.to_json(t.adoption(c)), "The draft resolution has been adopted as resolution 2448 (2018).", '{"adopted":"2448 (2018)"}'),
    (lambda c: F.to_json(t.adoption(c)), "Draft resolution was adopted by 113 votes to 2 (resolution 75/1).", '{"adopted":"75/1"}'),
    (lambda c: F.to_json(t.adoption(c)), "Draft resolution II, as orally corrected, was adopted (resolution 65/207).", '{"draft":"II","adopted":"65/207"}'),
    (lambda c: F.to_json(t.adoption(c)), "It was so decided.", "{}"),
    (t.is_adoption, "The draft decision was adopted.", True),
    (t.is_adoption, "The report was adopted.", False),
    (lambda c: t.entitled(c, F.lit("A/76/L.86")), 'Draft resolution A/76/L.86, entitled "One". Draft resolution L.87 is entitled “Two”.', "One"),
    (lambda c: t.entitled(c, F.lit("A/76/L.87")), 'Draft resolution A/76/L.86, entitled "One". Draft resolution L.87 is entitled “Two”.', "Two"),
    (lambda c: t.entitled(c, F.lit("A/76/L.9")), 'Draft resolution A/76/L.86, entitled "One".', "One"),
    (t.stage_direction, "Draft resolution A/1/L.2 was adopted.", "adoption"),
    (t.stage_direction, "It was decided to suspend; the meeting was suspended at noon.", "suspension"),
    (t.stage_direction, "The meeting rose at 6 p.m.", "adjournment"),
    (t.stage_direction, "(spoke in French)", "language_note"),
    (t.stage_direction, "The representatives observed a minute of silence.", "silence"),
    (lambda c: F.to_json(t.sponsorship(c)), "The following countries have become co-sponsors of draft resolution A/79/L.8: Chad, Peru and Fiji.", '{"kind":"list","symbol":"A/79/L.8","countries":["Chad","Peru","Fiji"]}'),
    (lambda c: F.to_json(t.sponsorship(c)), "We are pleased to co-sponsor draft resolution A/79/L.8.", '{"kind":"symbol","symbol":"A/79/L.8","countries":[]}'),
    (lambda c: F.to_json(t.sponsorship(c)), "My country co-sponsored the text on oceans (A/79/L.8).", '{"kind":"parenthesis","symbol":"A/79/L.8","countries":[]}'),
    (lambda c: F.to_json(t.sponsorship(c)), "We are proud to cosponsor this text.", '{"kind":"implicit","countries":[]}'),
    (t.sponsorship, "We were co-sponsor of the peace process.", None),
    (t.sponsorship, "We agree.", None),
    (t.country_list, "France and Germany", ["France", "Germany"]),
    (t.country_list, "None", []),
    (t.country_list, "", []),
    (lambda c: F.to_json(t.vote_totals(c)), "adopted by 121 votes to 5, with 3 abstentions", '{"yes":121,"no":5,"abstain":3}'),
    (lambda c: F.to_json(t.vote_totals(c)), "14 votes in favour to 0 against, with 1 abstention", '{"yes":14,"no":0,"abstain":1}'),
    (lambda c: F.to_json(t.vote_totals(c)), "adopted by 121 to 5", '{"yes":121,"no":5,"abstain":0}'),
    (lambda c: F.to_json(t.vote_totals(c)), "by ten votes to none, with two abstentions", '{"yes":10,"no":0,"abstain":2}'),
    (lambda c: F.to_json(t.vote_totals(c)), "It was so decided.", "{}"),
    (t.repair_draft_symbol, "A/C.I/64/L,J2 ;", "A/C.1/64/L.12"),
    (lambda c: F.to_json(t.adoption(c)), "Draft resolution A/64/L.72 was adopted (resolution 64/299).", '{"draft":"A/64/L.72","adopted":"64/299"}'),
    (lambda c: F.to_json(t.adoption(c)), "Draft resolution XIX was adopted.", '{"draft":"XIX"}'),
    (lambda c: F.to_json(t.adoption(c)), "The amendment (A/65/L.53) was adopted by 10 votes to 2.", '{"draft":"A/65/L.53"}'),
    (t.entitled, 'entitled "Old" and entitled “New title”', "New title"),
    (t.stage_direction, "The meeting was suspended at noon.", "suspension"),
    (t.stage_direction, "It was so decided.", "decision"),
    (t.stage_direction, "A list.", "other"),
    (t.mentions, "Pursuant to S/RES/1441(2002).", ["S/RES/1441"]),
    (t.mentions, "Resolution 5 was discussed.", []),
    (t.mentions, "See draft resolution A/C.3/78/L.5/Rev.1.", ["A/C.3/78/L.5/REV.1"]),
    (t.mentions, "resolution 64/299 and resolution 1441 (2002)", ["A/RES/64/299", "S/RES/1441"]),
    (t.cosponsors, "The co-sponsors are Algeria, Benin and Chad.", ["Algeria", "Benin", "Chad"]),
    (t.cosponsors, "We withdraw as co-sponsors: Algeria.", []),
    (t.on_behalf_of, "I speak on behalf of the Lakes Group, and", "Lakes Group"),
    (t.on_behalf_of, "on behalf of my people I greet", "my people"),
    (lambda c: F.to_json(t.agenda_header(c)), "Agenda item 12 (b) (continued) Question of peace", '{"agenda_number":12,"sub_item":"b","continued":true,"title":"Question of peace"}'),
    (lambda c: F.to_json(t.president(c)), "President: Mr. INSANALLY ........ (Guyana)", '{"name":"Mr. Insanally","country":"Guyana"}'),
    (lambda c: F.to_json(t.president(c)), "President: MR. INSANALLY _ (Guyana)", '{"name":"Mr. Insanally","country":"Guyana"}'),
    (t.president, "Nobody presides.", None),
    (lambda c: F.to_json(t.record_metadata(c)), "S/PV.3121 Forty-seventh year 3121st meeting 6 October 1992 New York President: Mr. Li (China)", '{"symbol":"S/PV.3121","session":47,"meeting_number":3121,"date":"1992-10-06","location":"New York","president":{"name":"Mr. Li","country":"China"},"body":"SC"}'),
    (lambda c: F.to_json(t.metadata_ladder(t.record_metadata(c), t.record_metadata(F.concat(F.lit("A/64/PV.2 "), c)))), "on 6 October 2009", '{"symbol":"A/64/PV.2","session":64,"meeting_number":2,"date":"2009-10-06","body":"GA"}'),
    (lambda c: t.speech_text(F.split(c, "@")), "1. Mr. AHMED (Pakistan): I should@ @like co- operation 08-51481 (E)@now", "I should\n\nlike cooperation \n\nnow"),
    (lambda c: t.vote_errors(c, F.struct(F.lit(1).alias("yes"), F.lit(None).cast("int").alias("no"), F.lit(0).alias("abstain")), F.array()), "recorded", ["no: missing", "votes: empty"]),
    (t.year_of_symbol, "S/2018/1016", 2018),
    (t.year_of_symbol, "A/2018/1016", None),
    (t.normalise_name, "Smith, John, 1950-2001", "John Smith"),
    (t.string_list, "['A', 'B']", ["A", "B"]),
    (t.string_list, "Solo", ["Solo"]),
    (t.bool_of, "TRUE", True),
    (t.bool_of, "maybe", None),
    (t.junk_flags, "?", ["short", "starts_non_letter", "sentinel"]),
    (t.topic_text, "A b-C 12 d", "a b c d"),
    (canonical_symbol, " resolution 1004 (1987)", "S/RES/1004"),
    (canonical_symbol, "a/res/ 33/2.", "A/RES/33/2"),
    (canonical_symbol, "20/12;", "A/RES/20/12"),
    (canonical_symbol, " ", None),
]


def test_all_cases(spark):
    df = spark.createDataFrame([(0,)], "i int")
    got = df.select(*(f(F.lit(x)).alias(f"c{k}") for k, (f, x, _) in enumerate(CASES))).first()
    wrong = [(x, want, got[k]) for k, (_, x, want) in enumerate(CASES) if got[k] != want]
    assert not wrong


@pytest.mark.parametrize("f", [t.normalize_allcaps, t.quality_score, t.mentions, t.country_list, t.speaker_info, t.stage_direction])
def test_null_and_long(spark, f):
    df = spark.createDataFrame([(None,), ("",), ("word " * 20000,)], "c string")
    assert df.select(f(F.col("c"))).count() == 3 and len(df.select(f(F.col("c")).alias("x")).collect()) == 3
