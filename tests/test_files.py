"""Payload files (F6): array, object, empty, malformed, zero-byte, scalar,
non-object element, non-string field, JSON Lines."""

import json
import os

from pyspark.sql import functions as F

from spanshade.plans.file_job import run_file_job
from spanshade.sources.json_files import INVALID, TOO_LARGE, read_payload_files
from spanshade.sources.sinks import current_version, rewrite_staged

CASES = {
    "a.json": json.dumps([{"verbatim_id": 1, "sentence": "call 555-123-4567"},
                          {"verbatim_id": 2, "sentence": "Thank you"}]),
    "b.json": json.dumps({"verbatim_id": 3, "sentence": "mail a@b.com"}),
    "c.json": "[]",
    "d.json": "{bad",
    "e.json": "",
    "f.json": "7",
    "g.json": json.dumps([{"verbatim_id": 4, "sentence": "ok"}, 5]),
    "h.json": json.dumps([{"verbatim_id": 8, "sentence": 99}]),
    "j.json": '{"verbatim_id": 11, "sentence": "a@b.com"}\n',
    "k.json": ' \t[{"verbatim_id": 12, "sentence": "x"}] \r\n\r\n',
    "l.json": '{"verbatim_id": 13} {"verbatim_id": 14, "sentence": "555-123-4567"}',
    "m.json": '[{"verbatim_id": 15}]\n[{"verbatim_id": 16}]',
    "n.json": '[{"verbatim_id": 17}] garbage',
    "o.json": '{"verbatim_id": 18}, {"verbatim_id": 19}',
    "p.json": '{"verbatim_id": 20}]',
    "i.json": '{"verbatim_id": 9, "sentence": "x"}\n{"verbatim_id": 10}\n',
}


def test_file_job(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for name, body in CASES.items():
        (src / name).write_text(body)
    jobs = run_file_job(spark, str(src / "*.json"), str(tmp_path / "out")).collect()
    by = {os.path.basename(r.source_file): r for r in jobs}
    assert set(by) == set(CASES)
    assert (by["a.json"].status, by["a.json"].total_payloads, by["a.json"].total_pii_detected,
            by["a.json"].payloads_with_pii) == ("success", 2, 1, 1)
    assert by["b.json"].total_pii_detected == 1
    assert by["c.json"].errors == ["No payloads found in file"]
    assert by["d.json"].errors == ["Invalid JSON format"]
    assert by["e.json"].errors == ["Invalid JSON format"]
    assert by["f.json"].errors == ["Unexpected JSON format"]
    assert by["g.json"].errors == ["'int' object has no attribute 'get'"]
    assert (by["h.json"].status, by["h.json"].total_pii_detected) == ("success", 0)
    assert by["i.json"].status == "failed"
    assert [by[f"{k}.json"].status for k in "jk"] == ["success"] * 2
    for k in "lmnop":
        assert (by[f"{k}.json"].status, by[f"{k}.json"].errors) == ("failed", ["Invalid JSON format"])
    a = by["a.json"]
    assert a.dest_file.startswith(f"{tmp_path}/out/source_name=a.json-") and os.path.isdir(a.dest_file)
    assert by["d.json"].dest_file is None
    assert a.detection_config.detection_methods == ["regex"]
    assert a.redaction_config.current_strategy == "placeholder"
    assert a.processing_seconds > 0 and a.processing_start < a.processing_end
    out = spark.read.text(str(tmp_path / "out")).collect()
    payloads = [json.loads(r.value) for r in out]
    red = {p["verbatim_id"]: p for p in payloads}
    assert red[1]["sentence"] == "call [REDACTED_PHONE]"
    assert red[1]["_redaction_metadata"]["redaction_count"] == 1
    assert "_redaction_metadata" not in red[2]
    assert red[8]["sentence"] == 99
    assert 14 not in red and 16 not in red


def test_equal_base_names_stay_apart(spark, tmp_path):
    for d in ("d1", "d2"):
        (tmp_path / "in" / d).mkdir(parents=True)
        (tmp_path / "in" / d / "calls.json").write_text(json.dumps([{"verbatim_id": f"{d}-{i}"} for i in range(50)]))
    jobs = run_file_job(spark, str(tmp_path / "in" / "*" / "*.json"), str(tmp_path / "out")).collect()
    assert len({r.dest_file for r in jobs}) == 2
    for r in jobs:
        parts = sorted(p for p in os.listdir(r.dest_file) if p.startswith("part-"))
        ids = [json.loads(x)["verbatim_id"] for p in parts for x in open(f"{r.dest_file}/{p}")]
        d = os.path.basename(os.path.dirname(r.source_file))
        assert ids == [f"{d}-{i}" for i in range(50)]


def test_value_beyond_the_variant_limit(spark, tmp_path):
    one = json.dumps({"verbatim_id": 1, "sentence": "mail a@b.com", "other": "x" * 1_000_000})
    (tmp_path / "big.json").write_text("[" + ",".join([one] * 150) + "]")
    (tmp_path / "texts.json").write_text(" [" + ",".join([one] * 149) + "," + json.dumps(json.dumps({"verbatim_id": 2})) + "]")
    (tmp_path / "object.json").write_text(json.dumps({f"k{i}": "x" * 1_000_000 for i in range(150)}))
    (tmp_path / "text.json").write_text(json.dumps("[" + "x" * 150_000_000 + "]"))
    rows = read_payload_files(spark, str(tmp_path / "*.json"))
    got = {os.path.basename(r.source_file): (r.n, r.error) for r in rows.groupBy("source_file").agg(
        F.count("payload").alias("n"), F.max("error").alias("error")).collect()}
    assert got["big.json"] == (150, None)
    assert got["texts.json"] == (0, "'str' object has no attribute 'get'")  # a text that holds an object is a text
    assert got["object.json"] == (0, TOO_LARGE)
    assert got["text.json"][0] == 0 and got["text.json"][1] in (INVALID, "Unexpected JSON format")


def test_json_lines(spark, tmp_path):
    lines = [json.dumps({"verbatim_id": i, "sentence": f"n{i}@b.com"}) for i in range(20)]
    (tmp_path / "good.jsonl").write_text("\n".join(lines) + "\n\n")
    (tmp_path / "bad.jsonl").write_text("\n".join([lines[0], "{oops", "7", lines[1] + lines[2], lines[3]]))
    rows = read_payload_files(spark, str(tmp_path / "*.jsonl"), fmt="jsonl")
    bad = rows.where("error IS NOT NULL").orderBy("payload_ordinal").collect()
    assert [r.error for r in bad] == ["Invalid JSON format", "'int' object has no attribute 'get'", "Invalid JSON format"]
    jobs = {os.path.basename(r.source_file): r for r in run_file_job(spark, str(tmp_path / "*.jsonl"), fmt="jsonl").collect()}
    assert (jobs["good.jsonl"].status, jobs["good.jsonl"].total_pii_detected) == ("success", 20)
    assert (jobs["bad.jsonl"].status, jobs["bad.jsonl"].total_payloads, jobs["bad.jsonl"].errors) == (
        "failed", 2, ["Invalid JSON format"])


def test_staged_rewrite_reads_its_own_old_version(spark, tmp_path):
    base = str(tmp_path / "data")
    assert current_version(spark, base) is None
    rewrite_staged(spark.range(5), base)
    old = spark.read.parquet(current_version(spark, base))
    path = rewrite_staged(old.selectExpr("id + 1 AS id"), base)
    assert path.endswith("/v2") and current_version(spark, base) == path
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]
    assert old.count() == 5


def test_small_files_share_tasks(spark, tmp_path):
    from spanshade.sources.json_files import classify_files
    n, most = 40, int(spark.conf.get("spark.sql.shuffle.partitions"))
    for i in range(n):
        (tmp_path / f"{i}.json").write_text(json.dumps([{"verbatim_id": i}]))
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64")  # a scan task for every file
    try:
        raw = spark.read.text(str(tmp_path), wholetext=True)
        assert raw.rdd.getNumPartitions() == n > most
        rows = classify_files(raw).select("source_file", "error", F.size("arr").alias("n"), F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set(size, before)
    assert len({r.source_file for r in rows}) == len(rows) == n and all(r.error is None and r.n == 1 for r in rows)
    assert 1 < len({r.task for r in rows}) <= most
