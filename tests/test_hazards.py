"""Regex safety on long texts (stack depth, quadratic backtracking)."""

import time

from pyspark.sql import functions as F

from spanshade.operators.detect import with_entities


def test_long_name_run_does_not_crash(spark):
    text = "i am " + "word " * 20000
    df = spark.createDataFrame([(1, text)], "id int, t string")
    r = with_entities(df, "t", "e").first()
    assert r.e[0].entity_type == "NAME" and r.e[0].start_pos == 5


def test_long_run_without_comma_is_linear(spark):
    df = spark.createDataFrame([(1, "word " * 20000), (2, "word " * 20000 + ", end")],
                               "id int, t string")
    t0 = time.time()
    rows = with_entities(df, "t", "e").orderBy("id").collect()
    assert time.time() - t0 < 60
    assert rows[0].e == []
    assert rows[1].e[0].entity_type == "ADDRESS" and rows[1].e[0].start_pos == 0


def test_astral_offsets(spark):
    text = "\U0001F600\U0001F600 mail a@b.com \U0001F600 555-123-4567"
    df = spark.createDataFrame([(1, text)], "id int, t string")
    e = with_entities(df, "t", "e").first().e
    assert [(x.entity_type, x.start_pos, x.end_pos) for x in e] == [
        ("EMAIL", 8, 15), ("PHONE", 18, 30)]
    assert text[8:15] == "a@b.com" and text[18:30] == "555-123-4567"
