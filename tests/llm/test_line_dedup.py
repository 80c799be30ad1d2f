import random
from collections import defaultdict

import numpy as np
from helpers import ascii_lower, empty_docs, odd_docs
from pyspark.sql import functions as F

from spanshade.llm import line_dedup as ld


def brute(rows, min_docs=3, min_chars=20):
    key = lambda x: ascii_lower(x.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < min_docs or i is not None and i == max(j for j in held[key(x)] if j is not None)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


def many(n=200, seed=4):
    rng = random.Random(seed)
    common = [f"A common line with number {i}, long enough." for i in range(30)]
    return [(1000 + i, "\n".join(rng.choice(common) if rng.random() < 0.4 else f"own line of {i}: {rng.random()}"
                                 for _ in range(rng.randint(1, 12)))) for i in range(n)]


def test_against_brute_force(spark):
    docs = odd_docs(spark, many()).withColumn("n_lines", F.lit("clash")).withColumn("keys", F.lit("kept"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    out = ld.dedup_lines(docs)
    assert out.columns == [*[c for c in docs.columns if c != "n_lines"], "n_lines", "n_dropped"]
    assert got(out) == want
    assert got(ld.apply_lines(docs, ld.build(docs), max_filter_bytes=0)) == want  # without filters


def test_insert_then_delete_is_reversible(spark):
    first, more = many(60, 1), [(i + 5000, t) for i, t in many(40, 2)]
    a, b = (spark.createDataFrame(x, "doc_id long, text string") for x in (first, more))
    state = ld.build(a)
    grown = ld.insert(state, b)
    both = a.union(b)
    assert got(ld.apply_lines(both, grown)) == brute(first + more)
    back = ld.delete(grown, b.select("doc_id"))
    assert got(ld.apply_lines(a, back)) == brute(first)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(back.counts) == rows(state.counts)
    probe = ld.Probe(back.filters.collect(), back.shards)
    kept = [bytes(r.key) for r in back.counts.where("refs >= 3").collect()]
    gone = [bytes(r.key) for r in grown.counts.where("refs >= 3").collect() if bytes(r.key) not in set(kept)]
    assert probe.hits(kept).all() and len(gone) > 0 and probe.hits(gone).mean() < 0.2


def test_null_ids_are_one_document_through_all_changes(spark):
    line = "A line that stands in several documents."
    of = lambda *ids: spark.createDataFrame([(i, line) for i in ids], "doc_id long, text string")
    grown = ld.insert(ld.build(of(1, None)), of(None))
    assert [r.refs for r in grown.counts.collect()] == [2]
    grown = ld.insert(grown, of(None, 2))
    want = [r.refs for r in ld.build(of(1, None, None, 2)).counts.collect()]
    assert [r.refs for r in grown.counts.collect()] == want == [3]
    rows = [(1, line), (None, line), (None, line), (2, line)]
    assert got(ld.apply_lines(of(1, None, None, 2), grown)) == brute(rows)
    back = ld.delete(grown, of(None).select("doc_id"))
    assert [(r.refs, r.top) for r in back.counts.collect()] == [(2, 2)]
    assert got(ld.apply_lines(of(1, 2), back)) == brute([(1, line), (2, line)])


def test_sql_counts_null_ids_alike(spark, tmp_path):
    import duckdb

    from spanshade.llm.oracle import SQL
    from spanshade.llm.queries import op7_line_dedup

    odd_docs(spark, many(40)).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    rel = con.sql(SQL["op7_line_dedup"])
    at = [rel.columns.index(c) for c in ("doc_id", "n_lines", "n_dropped", "kept_sha256")]
    rows = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in op7_line_dedup(spark, str(tmp_path)).collect()]
    assert sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str) == sorted(rows, key=str)


def test_cuckoo_filter_overflows_into_its_stash():
    rng = random.Random(5)
    slots, stash = np.zeros((16, ld.SLOTS), np.uint16), set()
    hs = [rng.getrandbits(64) for _ in range(90)]
    for h in hs:
        ld.cuckoo_insert(slots, stash, h)
    assert stash and (slots != 0).sum() + len(stash) == 90
    for h in hs:
        ld.cuckoo_delete(slots, stash, h)
    assert not stash and not slots.any()


def test_empty(spark):
    assert ld.dedup_lines(empty_docs(spark)).collect() == []
