import hashlib
import re
from collections import defaultdict

from helpers import WHITE, empty_docs, odd_docs
from pyspark.sql import functions as F

from spanshade.llm import exact_dedup as ed


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(WHITE, " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, keep, len(ids), (i == keep) if i is not None and keep is not None else len(ids) == 1, sha) for i in ids]
    return sorted(out, key=str)


def test_against_brute_force(spark):
    docs = odd_docs(spark, [(200 + i, f"copy {i % 7}") for i in range(80)] + [(300 + i, f"alone {i}") for i in range(500)])
    docs = docs.withColumn("kept", F.lit("clash")).withColumn("sha", F.lit(1))
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    for limit in (128 << 20, 64):  # one hash range, and many
        assert sorted((tuple(r) for r in ed.exact_dedup(docs, max_filter_bytes=limit).collect()), key=str) == want


def test_filter_misses_no_repeat_and_passes_most_others(spark):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("h"))
    both = hashes.union(hashes.where("h % 10 = 0")).repartition(6)
    filt = ed.repeated_filter(both, 5)
    h = hashes.toPandas().h.to_numpy()
    p = ed.positions(h, 5)
    hit = ((filt[p >> 3] >> (7 - (p & 7)).astype("uint8")) & 1).all(axis=0)
    assert hit[h % 10 == 0].all()
    assert hit[h % 10 != 0].mean() < 0.1


def test_a_range_reads_only_its_own_files(spark, monkeypatch):
    read = []
    monkeypatch.setattr(ed, "repeated_filter", lambda hashes, blocks, whole=ed.repeated_filter: read.append(hashes) or whole(hashes, blocks))
    docs = spark.createDataFrame([(i, f"text {i % 700}") for i in range(1000)], "doc_id long, text string")
    assert ed.exact_dedup(docs, max_filter_bytes=256).count() == 1000
    assert len(read) > 3
    for r, hashes in enumerate(read):
        plan = hashes._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(range#" in plan and f"= {r})" in plan


def test_hashes_are_held_up_to_a_bound(spark, monkeypatch):
    monkeypatch.setattr(ed, "HELD_ROWS", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        test_filter_misses_no_repeat_and_passes_most_others(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty(spark):
    assert ed.exact_dedup(empty_docs(spark)).collect() == []
