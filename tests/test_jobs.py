"""Canonical hash labels (R5), feedback jobs (W1-W6), streaming (ST1), session options."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from spanshade.operators.canonical import redact_canonical
from spanshade.operators.detect import detect_table, with_entities
from spanshade.operators.redact import with_redaction
from spanshade.plans import feedback
from spanshade.session import INPUT_PARTITIONS, dealt, ensure_checkpoint_dir, materialize, owning, release
from spanshade.streaming.redact_stream import redact_stream


def test_canonical_first_seen_label(spark):
    # the same text is an EMAIL in record 1 and would be hashed with another
    # type elsewhere; the first-seen (record 1) type labels every occurrence
    ENT = ("struct<text:string,entity_type:string,start_pos:int,end_pos:int,"
           "confidence:double,source:string>")
    texts = spark.createDataFrame([(1, "a@b.com x"), (2, "y a@b.com")], "k int, text string")
    ents = spark.createDataFrame([
        (1, "a@b.com", "EMAIL", 0, 7, .8, "REGEX"),
        (2, "a@b.com", "OTHER", 2, 9, .9, "CER"),
    ], "k int, text string, entity_type string, start_pos int, end_pos int, "
       "confidence double, source string")
    out = {r.k: r.redacted_text for r in redact_canonical(texts, ents, "k").collect()}
    assert out == {1: "[EMAIL_357a20e8] x", 2: "y [EMAIL_357a20e8]"}


def test_residual_leaks_and_quarantine(spark):
    rows = [(1, "f1", "call 555-123-4567, SSN 123-45-6789"), (2, "f2", "mail a@b.com")]
    df = spark.createDataFrame(rows, "key int, source_file string, text string")
    d = with_entities(df, "text", "ents", types=["PHONE", "EMAIL"])
    d = with_redaction(d, "text", "ents", out_text="redacted_text")
    d = d.withColumn("spans", feedback.replacement_spans(F.col("redactions")))
    d = feedback.with_residual_leaks(d, "redacted_text", "spans", "leaks", types=["SSN"])
    leaks = feedback.explode_leaks(d.select("key", "source_file", "leaks"),
                                   ["key", "source_file"])
    got = [(r.key, r.entity_type, r.text) for r in leaks.collect()]
    assert got == [(1, "SSN", "123-45-6789")]
    q, clean = feedback.quarantine(df, leaks)
    assert [r.key for r in q.collect()] == [1]
    assert [r.key for r in clean.collect()] == [2]
    alerts = feedback.leak_alerts(leaks).collect()
    assert [(a.source_file, a.entity_type, a.n_leaks) for a in alerts] == [("f1", "SSN", 1)]


def test_spans_in_redacted_text(spark):
    df = spark.createDataFrame([(1, "x 555-123-4567 y a@b.com z")], "key int, text string")
    d = with_redaction(with_entities(df, "text", "e"), "text", "e", out_text="r")
    r = d.select("r", feedback.replacement_spans(F.col("redactions")).alias("s")).first()
    assert [r.r[s.start_pos:s.end_pos] for s in r.s] == ["[REDACTED_PHONE]", "[REDACTED_EMAIL]"]


def test_stream_is_idempotent_per_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(3):
        (src / f"f{i}.json").write_text(json.dumps(
            [{"verbatim_id": i, "sentence": f"call 555-123-000{i}"}]))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    jobs = redact_stream(spark, str(src), out, ckpt, max_files_per_trigger=1)
    assert sorted(r.total_pii_detected for r in jobs.collect()) == [1, 1, 1]
    # a second run over the same folder with the same checkpoint adds nothing
    jobs2 = redact_stream(spark, str(src), out, ckpt, max_files_per_trigger=1)
    assert jobs2.count() == 3
    red = [json.loads(r.value)["sentence"] for r in spark.read.text(out + "/redacted").collect()]
    assert sorted(red) == ["call [REDACTED_PHONE]"] * 3


def test_zero_byte_files_reach_the_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(json.dumps({"verbatim_id": 1, "sentence": "a@b.com"}))
    (src / "empty.json").write_text("")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    redact_stream(spark, str(src), out, ckpt)
    (src / "b.json").write_text(json.dumps({"verbatim_id": 2, "sentence": "x"}))
    jobs = redact_stream(spark, str(src), out, ckpt).collect()
    assert sorted((os.path.basename(r.source_file), r.status) for r in jobs) == [
        ("a.json", "success"), ("b.json", "success"), ("empty.json", "failed")]
    base = spark.conf.get("spark.checkpoint.dir")
    assert not [d for d in os.listdir(f"{base}/spanshade-tables") if d.startswith("stream-batch")]


def test_a_batch_lists_only_what_changed(spark, tmp_path, monkeypatch):
    from spanshade.streaming import redact_stream as rs

    visited = []
    monkeypatch.setattr(rs, "_listed", lambda fs, folder, whole=rs._listed: visited.append(folder.getName()) or whole(fs, folder))
    src = tmp_path / "in"
    for d in range(4):
        (src / f"d{d}" / "deep").mkdir(parents=True)
        (src / f"d{d}" / "empty.json").write_text("")
    time.sleep(0.05)
    (src / "d0" / "a.json").write_text(json.dumps({"verbatim_id": 1, "sentence": "a@b.com"}))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def batch():
        del visited[:]
        time.sleep(0.05)
        return sorted(os.path.relpath(r.source_file.removeprefix("file:"), src) for r in redact_stream(
            spark, str(src / "d*"), out, ckpt).collect())

    told = ["d0/a.json", *[f"d{d}/empty.json" for d in range(4)]]
    assert batch() == sorted(told) and sorted(visited) == ["d0", "d1", "d2", "d3", *["deep"] * 4]
    time.sleep(0.05)
    (src / "d2" / "deep" / "late.json").write_text("")
    (src / "d3" / "b.json").write_text(json.dumps({"verbatim_id": 2}))
    told += ["d2/deep/late.json", "d3/b.json"]
    assert batch() == sorted(told)
    assert set(visited) <= {"deep", "d3", "d0"} and len(visited) < 8  # d0 changed last: it bears the mark
    (src / "d3" / "c.json").write_text(json.dumps({"verbatim_id": 3}))
    assert batch() == sorted([*told, "d3/c.json"]) and len(visited) <= 2  # d3, and what changed with it before


def test_inputs_are_dealt_only_on_request(spark):
    one = spark.range(100).coalesce(1)
    assert dealt(one, "id").rdd.getNumPartitions() == 1
    spark.conf.set(INPUT_PARTITIONS, "5")
    try:
        assert dealt(one, "id").rdd.getNumPartitions() == 5
    finally:
        spark.conf.unset(INPUT_PARTITIONS)


def test_an_owner_drops_its_tables(spark):
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/spanshade-tables"
    kept = materialize(spark.range(3), "kept")
    before = set(os.listdir(folder))
    with owning(spark):
        first, second = materialize(spark.range(5), "a"), materialize(spark.range(7), "b")
        assert first.count() + second.count() == 12
        release(first)
    assert set(os.listdir(folder)) == before and kept.count() == 3
    release(kept)


def test_checkpoint_folder_is_required_on_a_cluster():
    class Conf(dict):
        def get(self, k, d=None):
            return dict.get(self, k, d)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_detect_table_has_byte_offsets(spark):
    df = spark.createDataFrame([(1, "é a@b.com")], "k int, t string")
    r = detect_table(df, "k", "t").first()
    assert (r.start_pos, r.byte_start, r.byte_end) == (2, 3, 10)


def test_rates_result_struct_merge_and_first_rows(spark):
    from spanshade.operators.entities import with_rank
    from spanshade.operators.merge import merge_entity_lists
    from spanshade.operators.redact import redaction_result
    from spanshade.operators.stats import first_rows, job_rates

    jobs = spark.createDataFrame([(10, 4), (30, 6)], "total_payloads int, total_pii_detected int")
    r = job_rates(jobs, 4.0).first()
    assert (r.entities_per_payload, r.payloads_per_second) == (0.25, 10.0)

    df = with_entities(spark.createDataFrame([(2, "mail a@b.com"), (1, "none")], "k int, t string"), "t", "e")
    out = {x.k: x.result for x in redaction_result(df, "t", "e").collect()}
    assert (out[2].redacted_text, out[2].redaction_count, out[2].strategy_used) == ("mail [REDACTED_EMAIL]", 1, "placeholder")
    assert (out[1].redacted_text, out[1].redaction_count) == ("none", 0)

    both = df.select("k", merge_entity_lists(with_rank(F.col("e")), with_rank(F.col("e"), 1)).alias("m"))
    assert sorted((x.k, len(x.m)) for x in both.collect()) == [(1, 0), (2, 1)]
    assert [x.k for x in first_rows(df, "k", 1).collect()] == [1]
