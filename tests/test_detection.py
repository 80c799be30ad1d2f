"""Golden detection results (FIXTURES F1, F2, F7) and catalogue checks."""

import re

import pytest
from pyspark.sql import functions as F

from spanshade.functions.patterns import CATALOGUE, patterns_for_type, all_pattern_types
from spanshade.operators.detect import detect_table, with_candidates, with_entities, with_entities_of_texts


def _ents(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = with_entities(df, "t", "e", **kw).orderBy("id").collect()
    return [[(e.entity_type, e.start_pos, e.end_pos) for e in r.e] for r in rows]


def _cands(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = with_candidates(df, "t", "c", **kw).orderBy("id").collect()
    return [[(e.entity_type, e.start_pos, e.end_pos) for e in r.c] for r in rows]


F1 = ["Mhm.", "Yeah, yeah Yeah Yeah.", "It is 10 Test Lane, um, also Test, New York, 14625.",
      "It is my first and last name, testtest@gmail."]
F2 = ["Customer John Smith called from john.smith@email.com",
      "Please call me back at 555-123-4567 or (555) 987-6543",
      "My address is 123 Main Street, Springfield, IL 62701",
      "Thank you for your help today"]


def test_f1_payload_file_entities(spark):
    assert _ents(spark, F1) == [
        [],
        [("ADDRESS", 0, 20)],
        [("ADDRESS", 6, 18), ("ADDRESS", 24, 50)],
        [("ADDRESS", 0, 38)],
    ]


def test_f1_raw_candidates(spark):
    c = _cands(spark, F1)
    assert sorted(c[2]) == sorted([("ADDRESS", 6, 18), ("ADDRESS", 8, 22), ("ADDRESS", 24, 50),
                                   ("ZIP_CODE", 45, 50)])
    assert sorted(c[3]) == sorted([("ADDRESS", 0, 38), ("EMAIL", 30, 44), ("NAME", 30, 38)])


def test_f2_smoke_sample(spark):
    assert _ents(spark, F2) == [
        [("EMAIL", 32, 52)],
        [("PHONE", 23, 35), ("PHONE", 39, 53)],
        [("ADDRESS", 14, 29), ("ZIP_CODE", 47, 52)],
        [],
    ]


def test_f7_edge_texts(spark):
    assert _ents(spark, ["zip 12345-6789 \U0001F600 a@b.com", "It's the 10 best days",
                         "I am going to the shop", None, "   \t"]) == [
        [("SSN", 4, 14), ("EMAIL", 17, 24)],
        [("ADDRESS", 9, 16)],
        [("NAME", 5, 22)],
        [], [],
    ]


def test_entity_text_matches_offsets(spark):
    texts = F1 + F2 + ["zip 12345-6789 \U0001F600 a@b.com, é Ünïcode, X"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    d = with_entities(df, "t", "e")
    bad = d.where(~F.forall("e", lambda e: F.substring("t", e["start_pos"] + 1,
                                                       e["end_pos"] - e["start_pos"]) == e["text"]))
    assert bad.count() == 0


def test_marker_characters_take_exact_path(spark):
    # a text containing the marker characters must give the same spans
    base = "call 555-123-4567, then Main Street, ok"
    a = _ents(spark, [base])[0]
    b = _ents(spark, [base + "\u0001\u0000"])[0]
    assert a == b


def test_types_subset_and_catalogue():
    assert all_pattern_types() == ["EMAIL", "PHONE", "SSN", "ZIP_CODE", "ADDRESS",
                                   "CREDIT_CARD", "NAME"]
    assert len(CATALOGUE) == 12
    assert [p.ordinal for p in patterns_for_type("PHONE")] == [2, 3, 4]
    assert patterns_for_type("NOPE") == []


def test_types_argument(spark):
    assert _ents(spark, F2, types=["PHONE"]) == [[], [("PHONE", 23, 35), ("PHONE", 39, 53)],
                                                 [], []]


SAMPLES = F1 + F2 + [
    "reach me: JOHN@EXAMPLE.ORG or jane.doe@mail, (212)555-0199, 212 555 0199",
    "SSN 123-45-6789 and 123456789; card 4444 4444 4444 4444; zip 02139",
    "My name is Ann Lee Smith. first and last name, Bob Ray",
    "Lives at 42 Elm Road, near Oak Ct; also 7 grand ave",
    "words, more words, 12345 and then, again",
    "I'm Tom",
    "a, b, c, d",
]


@pytest.mark.parametrize("p", CATALOGUE, ids=lambda p: f"{p.ordinal}-{p.entity_type}")
def test_java_form_equals_published_form(spark, p):
    """The JVM form of each pattern returns the published match list (checked
    against Python's re with the published pattern on the sample texts)."""
    df = spark.createDataFrame(list(enumerate(SAMPLES)), "id int, t string")
    got = with_candidates(df, "t", "c", patterns=[p], guards=False).orderBy("id").collect()
    for text, row in zip(SAMPLES, got):
        want = []
        for m in re.finditer(p.source, text, re.IGNORECASE):
            g = p.plain_group
            s, e = (m.start(g), m.end(g)) if g else (m.start(), m.end())
            t = text[s:e]
            if len(t.strip()) < 2:
                continue
            from spanshade.functions.patterns import FALSE_POSITIVES
            if t.lower() in [x.lower() for x in FALSE_POSITIVES.get(p.entity_type, ())]:
                continue
            want.append((s, e))
        assert [(e.start_pos, e.end_pos) for e in row.c] == want, text


def test_detect_table_long_form(spark):
    df = spark.createDataFrame(list(enumerate(F2)), "id int, t string")
    rows = detect_table(df, "id", "t").orderBy("id", "start_pos").collect()
    assert [(r.id, r.entity_type, r.start_pos, r.text) for r in rows] == [
        (0, "EMAIL", 32, "john.smith@email.com"), (1, "PHONE", 23, "555-123-4567"),
        (1, "PHONE", 39, "(555) 987-6543"), (2, "ADDRESS", 14, "123 Main Street"),
        (2, "ZIP_CODE", 47, "62701")]


def test_name_guard_asks_for_a_lead_in_in_any_case(spark):
    from spanshade.functions.patterns import FOLDED_LETTERS

    names = patterns_for_type("NAME")
    assert all(p.guard for p in names)  # without one, both patterns search every text
    texts = ["i AM Ann", "İ am Ann", "ı'm Ann Lee", "My Name Iſ Ann", "Fırſt and last name, Ann Lee", "no lead-in: Ann Lee",
             "I a Ann", "", None, "é I'M Zoë", *[f"MY NAME IS{c} Ann" for c in FOLDED_LETTERS]]
    assert _cands(spark, texts, types=["NAME"]) == _cands(spark, texts, types=["NAME"], guards=False)
    df = spark.createDataFrame([(0, texts)], "id int, ts array<string>")
    guarded, plain = (with_entities_of_texts(df, "ts", "e", types=["NAME"], guards=g).first().e for g in (True, False))
    assert guarded == plain and sum(map(len, guarded)) == 6


def test_marker_in_the_text_is_mapped(spark):
    assert _ents(spark, ["\u0000 I am Ann\u0000, a@b.com \u0000"]) == [[("NAME", 7, 10), ("EMAIL", 13, 20)]]
