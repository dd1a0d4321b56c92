import pytest

from rostrum.llm.peg import alt, find, many, rx, seq, text_of
from rostrum.llm.transcripts import annotation, clean, speaker_turns, turns


def numbers(text, name=None, role=None):
    return [no for no, _, _ in turns(text, name, role)]


def test_peg():
    r = seq(rx("a", "x"), many(alt(rx("b", "y"), rx("c"))), name="top")("abcb!", 0)
    assert r[1] == 4 and text_of(r[0]) == "abcb" and text_of(find(r[0], "y")) == "b"
    assert annotation("[a (b) {c <d>}] e", 0)[1] == 15 and annotation("[never closed", 0) is None


def test_cleaning():
    assert clean("Only uh, 4 per cent [applause (long)] of of the um... pledges, you know, were kept.") == "Only 4 per cent of the pledges, were kept."


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Mr. BARO (Lemira): One.\n[applause]\nTwo.\nThe President: Three.\nBaro; Four.\nTHE PRESIDENT - Five.", [1, 2, 1, 2]),
        ("[00:10] Baro: One.\n[00:30] Mrs Rado [LEM]: Three.\n[00:20] Two, still Baro.\n[00:40] Bar0: Four.", [1, 2, 1]),
        ("1\n00:00:10.000 --> 00:00:12.000\nMs. RADO (Lemira): One.\n\n2\n00:00:20.000 --> 00:00:21.000\nThe Chair: Two.", [1, 2]),
        ("Mr. Baro\n10:05\nOne.\n\nAnna Rado\n10:10\nTwo.\n\nRado\n10:20\nThree. Article 12: no change.", [1, 2]),
        ("T+20s | Mr. BARO (Lemira) | One.\nT+40s | Baro | Three.\nT+30s | The President | Two.\nStill two.", [1, 2, 1]),
        ("Baro (10:20): Two.\nMrs. RADO (Lemira) (10:10): One.\nBaro (10:30): Three.", [1, 2]),
        ("Mr. Baro (Lemira): One. Mrs. Rado (Sonuru): Two; three. President: Four. I have one point: the budget.", [1, 2, 3]),
        ("I have one point: the budget. Article 12: no change is needed.", []),
        ("Mr. Baro (Lemira): I am alone. Mr. Baro (Lemira): Still alone.", []),
        ("The Chair's text - with one change - is ours.\nSECURITY COUNCIL - 4th meeting\nPage 5", []),
        ("Mr. Sato (Lemira): One.\nMs. Sato (Sonuru): Two.\nMr. Sato (Lemira): Three.", [1, 2, 1]),
        ("", []),
        (None, []),
        ("x" * 200_000, []),
    ],
)
def test_turns(text, want):
    assert numbers(text) == want


def test_president_is_the_row_s_speaker():
    text = "Mr. BARO (Lemira): One.\nThe President: Two.\nMr. RADO (Sonuru): Three."
    assert numbers(text, "Baro, Anton", "President") == [1, 2]
    assert numbers(text, "Anton Baro", "Representative") == [1, 2, 3]
    assert numbers(text, "The President", "President") == [1, 2, 3]


def test_brackets_nest_to_any_depth_and_unclosed_ones_are_text():
    for text in ("(" * 10_000 + "a", "([{<" * 3000 + ">}])" * 2999, "[(" * 3000 + ")" * 3000, "♪" * 5000):
        for t in (text, f"Mr. Baro: One {text}\nMs. Rado: Two."):
            assert len(turns(t)) in (0, 2)
    assert clean("a (loud [very <so>] noise) b") == "a b" and clean("(" * 10_000 + "x" + ")" * 10_000) == ""
    for t in ("c (unclosed d", "a () b", "a (b] c) d", "a (b\nc) d"):
        assert clean(t) == " ".join(t.split())
    assert clean("a (b [c) d (e) f") == "a (b [c) d f"


def test_frame(spark):
    rows = [(1, "Mr. Baro: One.\nMs. Rado: Two.", "A. Baro", None, "clash"), (2, None, None, None, "clash"), (3, "", None, None, None), (1, "Mr. Baro: One.\nMs. Rado: Two.", "A. Baro", None, "clash")]
    df = spark.createDataFrame(rows, "id long, text string, name string, role string, words string")
    got = sorted((r.speech_id, r.turn_no, r.speaker_no, r.words) for r in speaker_turns(df).collect())
    assert got == [(1, 1, 1, "One."), (1, 1, 1, "One."), (1, 2, 2, "Two."), (1, 2, 2, "Two.")]
    assert speaker_turns(df.where("false")).count() == 0
