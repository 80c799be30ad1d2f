"""What a record's steps hold and repeat: no texts in states, one strip per mask, no copies by ``let``."""

import time

from pyspark.sql import functions as F

from spanshade.functions.strategies import replacement
from spanshade.operators import validate as val
from spanshade.operators.detect import _pattern_entities_sql, _running_sql
from spanshade.functions.patterns import CATALOGUE
from spanshade.operators.merge import _KEPT_TYPE, _STATE_TYPE


def test_states_hold_no_texts():
    """Was: the walk's state and result were whole entities, and the offsets' fold collected them (F4, F11, F13, F16)."""
    assert "string" not in _STATE_TYPE + _KEPT_TYPE
    assert "'out'" not in _pattern_entities_sql(CATALOGUE[8], "pc", 0.8)


def test_running_sums(spark):
    rows = [(n, [(i * 7919) % 1000 for i in range(n)]) for n in (1, 15, 16, 17, 255, 256, 257, 4096, 5000)]
    df = spark.createDataFrame(rows, "n int, ws array<bigint>")
    for r in df.select("ws", F.expr(_running_sql("ws")).alias("s")).collect():
        total, want = 0, []
        for x in r.ws:
            total += x
            want.append(total)
        assert r.s == want


def test_masks_strip_once(spark):
    """Was: 8 and more strips per entity (F4, F11)."""
    df = spark.createDataFrame([("t", "NAME")], "t string, y string")
    for strategy in ("mask", "partial"):
        plan = df.select(F.transform(F.array("t"), lambda t: replacement(t, "y", strategy)).alias("m"))
        text = plan._jdf.queryExecution().analyzed().toString()
        assert text.count("\\x{1C}-\\x{1F}]+$") == 1


def test_validation_of_a_hundred_originals_makes_no_grams(spark, monkeypatch):
    """Was: more than 16 originals made all grams of the text, in every length (F1)."""
    originals = ["x" * (i % 23 + 2) + str(i) for i in range(100)]
    text = "some words without any of them " * 20_000 + originals[7]
    df = spark.createDataFrame([(text, [(o,) for o in originals])], "t string, r array<struct<original_text:string>>")

    def seconds():
        t = time.time()
        r = df.select(val.validation("t", "t", "r").alias("v")).first()
        assert r.v.errors == [f"PII text '{originals[7]}' still present in redacted text"]
        return time.time() - t

    now = min(seconds() for _ in range(2))
    monkeypatch.setattr(val, "FEW", 16)
    assert seconds() > 2 * now
