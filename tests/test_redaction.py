"""Strategy goldens (F5), splice semantics (F3), payload job (A5-A8)."""

import pytest
from pyspark.sql import functions as F

from spanshade.functions.strategies import available_strategies, get_strategy, replacement
from spanshade.operators.detect import with_entities
from spanshade.operators.redact import with_redaction
from spanshade.operators.validate import validation
from spanshade.plans.payload_job import redact_payloads

F5 = [
    ("EMAIL", "john@email.com", "[REDACTED_EMAIL]", "jo***********m", "j***@email.com",
     "[EMAIL_41193cdb]"),
    ("PHONE", "555-123-4567", "[REDACTED_PHONE]", "55*********7", "***-***-4567",
     "[PHONE_ca71de05]"),
    ("CREDIT_CARD", "4444-4444-4444-4444", "[REDACTED_CREDIT_CARD]", "44****************4",
     "****-****-****-4444", "[CREDIT_CARD_ae5f7bbe]"),
    ("ZIP_CODE", "14625", "[REDACTED_ZIP]", "14**5", "1***5", "[ZIP_CODE_977a2656]"),
    ("NAME", "Jo", "[REDACTED_NAME]", "**", "**", "[NAME_955b420f]"),
    ("BANK_X", "abcd", "[REDACTED]", "a**d", "a**d", "[BANK_X_e2fc714c]"),
]


def test_strategy_goldens(spark):
    df = spark.createDataFrame([r[:2] for r in F5] + [("EMAIL", "@x")], "y string, t string")
    got = df.select(*[replacement("t", "y", s).alias(s) for s in available_strategies()]) \
        .collect()
    for row, g in zip(F5, got):
        _, _, ph, mask, partial, hsh = row
        assert (g.placeholder, g.mask, g.partial, g.hash, g.remove) == (ph, mask, partial, hsh, "")
    assert got[-1].partial == "*@x"


def test_unknown_strategy():
    with pytest.raises(ValueError, match="Available"):
        get_strategy("shred")


ENT = "struct<text:string,entity_type:string,start_pos:int,end_pos:int,confidence:double,source:string>"


def test_given_entities_right_to_left(spark):
    df = spark.createDataFrame([
        (1, "Call John Smith at john@email.com",
         [("John Smith", "PERSON", 5, 15, .9, "COMPREHEND"),
          ("john@email.com", "EMAIL", 19, 33, .95, "REGEX")]),
        (2, "Email me at john@email.com or call 555-123-4567",
         [("john@email.com", "EMAIL", 15, 29, .95, "REGEX"),
          ("555-123-4567", "PHONE", 45, 57, .9, "COMPREHEND")]),
    ], f"id int, t string, e array<{ENT}>")
    rows = with_redaction(df, "t", "e", out_text="r").orderBy("id").collect()
    assert rows[0].r == "Call [REDACTED_PERSON] at [REDACTED_EMAIL]"
    assert [x.entity_type for x in rows[0].redactions] == ["EMAIL", "PERSON"]
    assert rows[1].r == "Email me at joh[REDACTED_EMAIL] call 555-123-45[REDACTED_PHONE]"


def test_redaction_properties(spark):
    texts = ["It is 10 Test Lane, um, also Test, New York, 14625.",
             "call 555-123-4567 or mail a@b.com, please", "nothing here"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    d = with_entities(df, "t", "e")
    for s in available_strategies():
        r = with_redaction(d, "t", "e", s, out_text="r").collect()
        for row in r:
            delta = sum(len(x.replacement) - (x.end_pos - x.start_pos) for x in row.redactions)
            assert len(row.r) == len(row.t) + delta
            if not row.redactions:
                assert row.r == row.t


def test_validation(spark):
    df = spark.createDataFrame([(1, "my name is name", [("name", "NAME", 11, 15, .8, "REGEX")])],
                               f"id int, t string, e array<{ENT}>")
    d = with_redaction(df, "t", "e", out_text="r")
    v = d.select(validation("t", "r", "redactions").alias("v")).first().v
    assert v.is_valid is False and "still present" in v.errors[0]


def test_payload_job_metadata_and_stats(spark):
    df = spark.createDataFrame([
        (1, "Customer John Smith called from john.smith@email.com", None, 7),
        (2, "Thank you", "call 555-123-4567", 8),
        (3, "   ", None, 9),
    ], "verbatim_id long, sentence string, notes string, transcript int")
    out = redact_payloads(df).orderBy("verbatim_id").collect()
    assert out[0].sentence == "Customer John Smith called from [REDACTED_EMAIL]"
    assert out[0]._redaction_metadata.redaction_count == 1
    assert out[0]._redaction_metadata.redactions[0].field_name == "sentence"
    assert out[1].notes == "call [REDACTED_PHONE]"
    assert out[1]._stats.fields_with_pii == ["notes"]
    assert out[2]._redaction_metadata is None and out[2]._stats.pii_detected == 0
    assert out[0]._stats.payload_id == "1" and out[0]._stats.status == "success"
    assert out[0].transcript == 7  # non-string field untouched


GIVEN = "verbatim_id int, field_name string, begin_offset int, end_offset int, type string, score double, source string"


def _given(spark, **kw):
    from spanshade.plans.payload_job import redact_with_entities

    df = spark.createDataFrame([(1, "call Ann now", "x"), (2, "nothing", "y"), (3, "mail Bob", "z Bob"), (4, None, "n")],
                               "verbatim_id int, sentence string, notes string")
    ents = spark.createDataFrame([
        (1, "sentence", 5, 8, "PERSON", 0.9, "CER"), (9, "notes", 0, 1, "NAME", 0.9, "CER"),
        (3, "sentence", -3, 8, "PERSON", 0.9, "CER"), (3, "notes", 2, 5, "NAME", 0.9, "CER"),
        (4, "sentence", 0, 2, "NAME", 0.9, "CER")], GIVEN)
    return {r.verbatim_id: r for r in redact_with_entities(df, ents, **kw).collect()}


def test_given_entities_over_several_fields(spark):
    got = _given(spark)
    assert set(got) == {1, 2, 3, 4}
    assert got[1].sentence == "call [REDACTED_PERSON] now" and got[1]._redaction_metadata.redaction_count == 1
    assert got[2]._redaction_metadata is None and got[2]._stats.status == "success"
    # one unusable span: the whole payload passes through, as failed
    assert (got[3].sentence, got[3].notes, got[3]._stats.status, got[3]._stats.pii_detected) == ("mail Bob", "z Bob", "failed", 0)
    assert got[4]._stats.status == "failed"


def test_given_entities_paired_by_key_and_quarantine(spark):
    got = _given(spark, unmatched="drop", on_failure="quarantine")
    assert set(got) == {1, 3, 4}
    assert (got[3].sentence, got[3].notes, got[3]._stats.status) == (None, None, "failed")


def test_redacted_at_is_utc(spark):
    from datetime import datetime, timedelta, timezone

    from spanshade.operators.redact import utc_now

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = datetime.fromisoformat(spark.range(1).select(utc_now().alias("t")).first().t)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert abs(datetime.now(timezone.utc).replace(tzinfo=None) - got) < timedelta(minutes=5)


def test_strategy_registered_again_is_used(spark):
    from pyspark.sql import functions as F

    from spanshade.functions.strategies import register_strategy
    from spanshade.operators.detect import with_entities
    from spanshade.operators.redact import with_redaction

    df = with_entities(spark.createDataFrame([("a@b.com",)], "t string"), "t", "e")
    out = []
    for word in ("AAA", "BBB"):
        register_strategy("own", lambda text, kind, word=word: F.lit(word))
        out.append(with_redaction(df, "t", "e", "own", out_text="r").first().r)
    assert out == ["AAA", "BBB"]


def test_span_group_must_end_its_pattern(spark):
    import pytest

    from spanshade.operators.detect import with_entities

    df = spark.createDataFrame([("id=4711; ok",)], "t string")
    with pytest.raises(ValueError, match="must end the pattern"):
        with_entities(df, "t", "e", patterns=[("ACC", r"id=(\d+);", 1)])
    e = with_entities(df, "t", "e", patterns=[("ACC", r"id=(\d+)(?=;)", 1)]).first().e
    assert [(x.start_pos, x.end_pos, x.text) for x in e] == [(3, 7, "4711")]


def test_plans_of_feedback_and_labels(spark):
    """Raw text is not shuffled on its file, and labels need no sort of all entities."""
    from spanshade.operators.canonical import redact_canonical
    from spanshade.operators.detect import detect_table
    from spanshade.plans.feedback import quarantine

    raw = spark.createDataFrame([(1, "f", "a@b.com")], "key int, source_file string, text string")
    q, _ = quarantine(raw, raw.select("source_file"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(source_file" not in plan
    texts = raw.select("key", "text")
    out = redact_canonical(texts, detect_table(texts, "key", "text"), "key", "text")
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.first().redacted_text == "[EMAIL_357a20e8]"
