"""Work per record that must grow with the record, not with its square; results against plain Python."""

import random
import time

import pytest
from pyspark.sql import functions as F

from spanshade.operators import findings as fnd
from spanshade.operators import validate as val
from spanshade.operators.findings import attach_findings, cut_spans, findings_to_entities
from spanshade.operators.validate import validation
from spanshade.plans.feedback import outside, training_examples, with_residual_leaks

SPAN = "array<struct<start_pos:int,end_pos:int>>"
RECORD = "array<struct<original_text:string>>"


def overlaps(a, b):
    return a[0] < b[1] and a[1] > b[0]


def test_outside_against_all_pairs(spark):
    rnd = random.Random(2)

    def spans(n):
        return [(s, s + rnd.choice((0, 0, 1, 3, 30))) for s in (rnd.randint(0, 60) for _ in range(n))]

    rows = [(i, spans(rnd.randint(0, 12)), spans(rnd.randint(0, 12))) for i in range(400)]
    df = spark.createDataFrame(rows, f"i int, a {SPAN}, b {SPAN}")
    for r in df.select("i", outside(F.col("a"), F.col("b")).alias("o")).collect():
        _, a, b = rows[r.i]
        assert [tuple(x) for x in r.o] == [x for x in a if not any(overlaps(x, y) for y in b)]


@pytest.mark.parametrize("few,gram,window", [(16, 24, 1 << 16), (0, 3, 10), (0, 24, 7)])
def test_validation_against_plain_search(spark, monkeypatch, few, gram, window):
    monkeypatch.setattr(val, "FEW", few)
    monkeypatch.setattr(val, "GRAM", gram)
    monkeypatch.setattr(val, "WINDOW", window)
    rnd = random.Random(3)
    alphabet = "abA\n😀É."
    rows = []
    for i in range(150):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        originals = [None if rnd.random() < 0.05 else "".join(rnd.choice(alphabet) for _ in range(rnd.choice((0, 1, 2, 3, 5, 9))))
                     for _ in range(rnd.randint(0, 25))]
        originals += [text[k:k + 12] for k in (0, 3)]
        rows.append((i, text, [(o,) for o in originals]))
    df = spark.createDataFrame(rows, f"i int, t string, r {RECORD}")
    for r in df.select("i", validation("t", "t", "r").alias("v")).collect():
        _, text, records = rows[r.i]
        want = [f"PII text '{o}' still present in redacted text" for o, in records if o is not None and o.lower() in text.lower()]
        assert r.v.errors == want and r.v.is_valid == (not want)


def test_findings_cut_by_the_index(spark, monkeypatch):
    monkeypatch.setattr(fnd, "STEP", 4)
    text = "aé😀\nb日本" * 9
    spans = [(b, e) for b in range(-2, 66, 3) for e in (b - 1, b, b + 1, b + 5, b + 40)] + [(None, 3), (3, None)]
    rows = [(1, "text", b, e, "X", 0.5, "CER") for b, e in spans]
    f = spark.createDataFrame(rows, "id int, field_name string, begin_offset int, end_offset int, type string, score double, source string")
    df = spark.createDataFrame([(1, text), (2, None)], "id int, t string")
    f = f.unionByName(f.where("begin_offset = 1").withColumn("id", F.lit(2)))
    out = attach_findings(df, f, "id").select("id", findings_to_entities(F.col("findings"), F.col("t")).alias("e")).collect()
    got = {(e.start_pos, e.end_pos): e for r in out if r.id == 1 for e in r.e}
    for b, e in spans:
        ent = got[b, e]
        if b is not None and e is not None and 0 <= b <= e:
            assert ent.text == text[b:e]
            assert (ent.byte_start, ent.byte_end) == (len(text[:b].encode()), len(text[:e].encode()))
        else:
            assert (ent.byte_start, ent.byte_end) == (-1, -1)
    assert all(e.text is None and e.byte_start == -1 for r in out if r.id == 2 for e in r.e)
    kind = "array<struct<start_pos:int,end_pos:int,type:string,source:string>>"
    cut = spark.createDataFrame([(text, [(1, 9, "X", "CER"), (50, 70, "X", "CER")])], f"t string, s {kind}")
    assert [x.text for x in cut.select(cut_spans(F.col("t"), F.col("s")).alias("c")).first().c] == [text[1:9], text[50:70]]


def test_training_examples_against_all_pairs(spark):
    rnd = random.Random(4)
    texts = {k: "".join(rnd.choice("abé😀 ") for _ in range(80)) for k in range(30)}
    found = [(k, b, b + rnd.randint(0, 9), "T", "CER") for k in range(40) for b in rnd.choices(range(75), k=6)]
    taken = [(k, b, b + rnd.randint(0, 15)) for k in range(0, 40, 2) for b in rnd.choices(range(75), k=5)]
    q = spark.createDataFrame([(k, "f", t) for k, t in texts.items()], "key int, source_file string, text string")
    f = spark.createDataFrame(found, "key int, begin_offset int, end_offset int, type string, source string")
    r = spark.createDataFrame(taken, "key int, start_pos int, end_pos int")
    out = training_examples(q, f, r, "key")
    assert "NestedLoop" not in out._jdf.queryExecution().toString()
    want = sorted((k, texts[k][b:e], b, e) for k, b, e, *_ in found
                  if k in texts and not any(x == k and b < t and e > s for x, s, t in taken))
    assert sorted((x.key, x.text, x.begin_offset, x.end_offset) for x in out.collect()) == want


def doubling(seconds, n):
    """Twice the work takes at most 2.2 times as long (and half a second)."""
    seconds(n // 8)
    small = min(seconds(n) for _ in range(2))
    assert min(seconds(2 * n) for _ in range(2)) <= 2.2 * small + 0.5


def timed(df, *cols):
    t = time.time()
    df.select(*cols).write.format("noop").mode("overwrite").save()
    return time.time() - t


def test_validation_grows_linearly(spark):
    def seconds(n):
        words = [f"person{i}@example.com" for i in range(n)]
        kept = " ".join(w if i % 2 else "[REDACTED_EMAIL]" for i, w in enumerate(words))
        df = spark.createDataFrame([(" ".join(words), kept, [(w,) for w in words])], f"o string, t string, r {RECORD}")
        return timed(df, validation("o", "t", "r").alias("v"))

    doubling(seconds, 8_000)


def test_findings_grow_linearly(spark):
    def seconds(n):
        text = "Mary Jones é " * n
        rows = [(1, "t", 13 * i, 13 * i + 10, "NAME", 0.5, "CER") for i in range(n)]
        f = spark.createDataFrame(rows, "id int, field_name string, begin_offset int, end_offset int, type string, score double, source string")
        df = attach_findings(spark.createDataFrame([(1, text)], "id int, t string"), f, "id")
        return timed(df, findings_to_entities(F.col("findings"), F.col("t")).alias("e"))

    doubling(seconds, 8_000)


def test_residual_scan_grows_linearly(spark):
    def seconds(n):
        text = "a1@ex.com [REDACTED_NAME] " * n
        df = spark.createDataFrame([(text, [(26 * i + 10, 26 * i + 25) for i in range(n)])], f"t string, s {SPAN}")
        return timed(with_residual_leaks(df, "t", "s", types=["EMAIL"]), "leaks")

    doubling(seconds, 8_000)
