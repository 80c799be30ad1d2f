"""Jobs over several runs: restarts, growing sets, labels; positional pairing; times."""

import json
import os

import pytest
from pyspark.sql import functions as F

from spanshade.operators import canonical
from spanshade.operators.canonical import redact_canonical
from spanshade.operators.pairing import with_ordinals, zip_rows
from spanshade.plans import file_job as fj
from spanshade.plans.feedback import grow_training_set, training_set
from spanshade.plans.payload_job import RESULT_TYPE, redact_paired
from spanshade.sources import ledger


def put(folder, name, payloads):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(payloads if isinstance(payloads, str) else json.dumps(payloads))


def texts(df):
    return sorted(json.loads(r.value)["sentence"] for r in df.collect())


def names(jobs):
    return sorted(os.path.basename(r.source_file) for r in jobs.collect())


def test_restartable_job(spark, tmp_path, monkeypatch):
    src, out = tmp_path / "in", str(tmp_path / "out")
    put(src, "a b.json", [{"sentence": "a@b.com"}])
    put(src, "b.json", [{"sentence": "call 555-123-4567"}, {"sentence": "x"}])
    put(src, "bad.json", "{bad")
    put(src, "none.json", "")
    assert fj.published(spark, out).collect() == []

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # the output is written, the run is not marked
        m.setattr(fj, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            fj.run_restartable(spark, str(src), out, "one")
    assert os.path.isdir(f"{out}/files/data/run=one") and fj.published(spark, out).collect() == []

    first = fj.run_restartable(spark, str(src), out, "one")
    assert names(first) == ["a%20b.json", "b.json", "bad.json", "none.json"]
    want = ["[REDACTED_EMAIL]", "call [REDACTED_PHONE]", "x"]
    assert texts(fj.published(spark, out)) == want
    again = fj.run_restartable(spark, str(src), out, "one")  # marked: nothing is done
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))

    put(src, "c.json", [{"sentence": "new"}])
    put(src, "bad.json", [{"sentence": "mended"}])
    second = fj.run_restartable(spark, str(src), out, "two")
    assert names(second) == ["bad.json", "c.json", "none.json"]
    assert texts(fj.published(spark, out)) == sorted([*want, "new", "mended"])

    put(src, "c.json", [{"sentence": "changed and longer"}])
    assert names(fj.run_restartable(spark, str(src), out, "three")) == ["c.json", "none.json"]
    os.remove(src / "none.json")
    assert names(fj.run_restartable(spark, str(src), out, "four")) == []
    assert texts(fj.published(spark, out)) == sorted([*want, "changed and longer", "mended"])


def test_run_ids(spark, tmp_path):
    for bad in ("", "a/b", "_x", "a=b"):
        with pytest.raises(ValueError):
            ledger.run_path(str(tmp_path), bad)
    assert ledger.committed_runs(spark, str(tmp_path / "nothing")) == []


def test_file_times(spark, tmp_path):
    src = tmp_path / "in"
    put(src, "small.json", [{"sentence": "a@b.com"}])
    put(src, "large.json", [{"sentence": f"mail a{i}@b.com or call 555-123-4567. " * 20} for i in range(3000)])
    put(src, "bad.json", "{bad")
    jobs = {os.path.basename(r.source_file): r for r in fj.run_file_job(spark, str(src), str(tmp_path / "out")).collect()}
    assert jobs["large.json"].processing_seconds > 2 * jobs["small.json"].processing_seconds > 0
    assert jobs["bad.json"].processing_seconds == 0.0
    assert all(r.processing_start < r.processing_end for r in jobs.values())


def test_training_set_grows(spark, tmp_path):
    def examples(*rows):
        return training_set(spark.createDataFrame(list(rows), "text string, type string, source_file string"))

    base = str(tmp_path / "set")
    one = examples(("a", "X", "f1"), ("a", "X", "f2"), (None, "X", "f1"))
    two = examples(("a", "X", "f9"), ("a", "Y", "f3"), (None, "X", "f1"))
    whole = [("a", "X", 2, "f1"), (None, "X", 1, "f1")]
    assert sorted(map(tuple, grow_training_set(one, base, "r1").collect()), key=str) == sorted(whole, key=str)
    for run in ("r1", "r2"):  # a rerun adds nothing
        assert sorted(map(tuple, grow_training_set(one, base, run).collect()), key=str) == sorted(whole, key=str)
    whole.append(("a", "Y", 1, "f3"))
    for run in ("r3", "r3", "r4"):
        assert sorted(map(tuple, grow_training_set(two, base, run).collect()), key=str) == sorted(whole, key=str)


def test_labels_of_two_jobs_are_those_of_one(spark, tmp_path, monkeypatch):
    rows = [(1, "zip 12345-6789"), (2, "call 555 123 4567, Mary Lane"), (3, "I am Mary Lane"), (4, "my name is John"),
            (5, "I am in New Town, Some State"), (6, "I am Some State")]
    df = spark.createDataFrame(rows, "key int, text string")
    ents = spark.createDataFrame([
        (1, "Mary Lane", "ADDRESS", 0, 3), (3, "Mary Lane", "NAME", 5, 14), (2, "Mary Lane", "NAME", 19, 28),
        (5, "Some State", "ADDRESS", 18, 28), (6, "Some State", "NAME", 5, 15)],
        "key int, text string, entity_type string, start_pos int, end_pos int").selectExpr(
        "*", "0.8D confidence", "'REGEX' source")

    def redacted(keys, **kw):
        out = redact_canonical(df.where(F.col("key").isin(keys)), ents.where(F.col("key").isin(keys)), "key", "text", **kw)
        return {r.key: r.redacted_text for r in out.collect()}

    whole = redacted([1, 2, 3, 4, 5, 6])
    base = str(tmp_path / "labels")
    for _ in range(2):  # a rerun gives the same
        parts = redacted([1, 2, 3], label_base=base, run_id="one") | redacted([4, 5, 6], label_base=base, run_id="two")
        assert parts == whole
    assert "[ADDRESS_" in whole[2] and "[ADDRESS_" in whole[6]
    assert redacted([6])[6] != whole[6]  # alone it would be a NAME, and there is no label to join
    monkeypatch.setattr(canonical, "BROADCAST_BYTES", -1)
    assert redacted([1, 2, 3, 4, 5, 6]) == whole


def test_ordinals_and_zip(spark):
    left = spark.range(1000).selectExpr("(id * 7919) % 1000 as a").repartition(7)
    right = spark.range(640).selectExpr("-id as b").repartition(5)
    got = sorted((r.a, r.b) for r in zip_rows(left, right, "a", "b").collect())
    assert got == list(zip(range(1000), range(-639, 1)))
    got = sorted((r.b, r.a) for r in zip_rows(right, left, "b", "a").collect())
    assert got == list(zip(range(-639, 1), range(1000)))
    assert sorted(r.ordinal for r in with_ordinals(left).collect()) == list(range(1000))
    assert zip_rows(left.limit(0), right).collect() == []
    with pytest.raises(ValueError):
        zip_rows(left, left)


def test_paired_payloads(spark):
    payloads = spark.createDataFrame([(1, "John Smith", "  ", 5), (2, None, "call", 6), (3, "tail", "x", 7)],
                                     "verbatim_id int, sentence string, notes string, comments int")
    ent = ("John", "PERSON", 0, 4, 0.9, "CER")
    results = spark.createDataFrame([(10, {"sentence": [ent], "notes": [ent], "comments": [ent], "other": [ent]}),
                                     (20, {"sentence": [ent], "notes": None})], f"o int, entities_by_field {RESULT_TYPE}")
    out = redact_paired(payloads, results, payload_order="verbatim_id", result_order="o").orderBy("verbatim_id").collect()
    assert [(r.verbatim_id, r.sentence, r.notes, r.comments) for r in out] == [
        (1, "[REDACTED_PERSON] Smith", "  ", 5), (2, None, "call", 6)]
    assert [r._stats.pii_detected for r in out] == [1, 0]


def test_training_runs_read_examples_that_are_made_once(spark, monkeypatch):
    from spanshade.plans import feedback, queries
    made, read = [], []
    rows = [("conversations", i, "f", f"t{i % 3}", "NAME", "CER", 0) for i in range(6)]

    def union(s, sf_dir):
        made.append(sf_dir)
        return s.createDataFrame(rows, "src string, key bigint, source_file string, text string, type string, source string, start_pos int")

    def seen(examples, *a, **kw):
        read.append(examples)
        return training_set(examples, *a, **kw)

    monkeypatch.setattr(queries, "_examples_union", union)
    monkeypatch.setattr(feedback, "training_set", seen)
    got = queries.training_set_over_runs(spark, "none")
    assert sorted(map(tuple, got.collect())) == [(f"t{i}", "NAME") for i in range(3)]
    assert len(made) == 1 and len(read) == 3
    assert all("/spanshade-tables/training-examples-" in f for d in read for f in d.inputFiles()) and all(d.inputFiles() for d in read)
