"""The pipeline's rows against its stages done one by one in plain Python."""

from collections import defaultdict

import corpus_pipeline
import pytest
from test_line_dedup import brute as lines_brute
from test_mixing import brute as mix_brute
from test_simhash import classes, fingerprint

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    try:
        docs = spark.read.parquet(f"{SF}/documents.parquet")
    except Exception:
        pytest.skip("test tables not present")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert name == "tokens" or docs.columns == columns
        seen[name] = docs.collect()

    scored = {r.doc_id: r.predicted for r in E.queries()["op8_quality"](spark, SF).collect()}
    start = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(r.doc_id for r in seen["quality"]) == sorted(r.doc_id for r in start if scored[r.doc_id])

    want = {i: t for i, t, _, _ in lines_brute([(r.doc_id, r.text) for r in seen["quality"]])}
    assert {r.doc_id: r.text for r in seen["lines"]} == want
    assert all(r.n_chars == len(r.text) for r in seen["lines"])

    fps = {r.doc_id: fingerprint(r.text) for r in seen["lines"]}
    label = classes(sorted(set(fps.values())))
    first = {}
    for i in sorted(fps):
        first.setdefault(label[fps[i]], i)
    assert sorted(r.doc_id for r in seen["near"]) == sorted(first.values())

    taken = []
    for i, size, _, _, words in mix_brute([(r.doc_id, r.text, r.source) for r in seen["near"]]):
        taken += [i] * (words // size if size else 0)
    got = sorted(r.doc_id for r in seen["mix"])
    blank = {r.doc_id for r in seen["near"] if not (r.text or "").split()}
    assert [i for i in got if i not in blank] == sorted(i for i in taken if i not in blank)

    import sentencepiece
    from spanshade.llm.queries import piece_model

    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    texts = {r.doc_id: r.text for r in seen["mix"]}
    for r in seen["tokens"]:
        assert r.ids == sp.encode(texts[r.doc_id]) and r.decoded == sp.decode(r.ids) and r.n_tokens == len(r.ids)
    assert sorted(r.doc_id for r in seen["tokens"]) == got
    assert sorted((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(
        (r.doc_id, tuple(r.ids)) for r in seen["tokens"])


def test_only_the_last_table_stays(spark, tmp_path, monkeypatch):
    import os

    from spanshade.llm import common
    from spanshade.llm.queries import op4_simhash

    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    out = corpus_pipeline.run(spark, SF)
    assert [x.rsplit("-", 1)[0] for x in os.listdir(tmp_path / "llm")] == ["pipeline-tokens"] and out.count()
    with common.Owner(spark):
        op4_simhash(spark, SF).write.parquet(str(tmp_path / "out"))
    assert len(os.listdir(tmp_path / "llm")) == 1 and spark.read.parquet(str(tmp_path / "out")).count()


def plain(docs, scored):
    """doc_ids (with repeats) that the stages before the last leave, and their texts, in plain Python."""
    rows = [(k, r.doc_id, r.text, r.source) for k, r in enumerate(docs) if scored[r.text]]
    kept = iter(lines_brute_in_order([(i, t) for _, i, t, _ in rows]))
    rows = [(k, i, next(kept), s) for k, i, _, s in rows]
    fps = {k: fingerprint(t) for k, _, t, _ in rows}
    label = classes(sorted(set(fps.values())))
    first = {}
    for k, i, t, s in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0])):
        first.setdefault(label[fps[k]], (i, t, s))
    assert len({i for i, _, _ in first.values()}) == len(first)
    copies = {i: words // size if size else 0 for i, size, _, _, words in mix_brute(list(first.values()))}
    return sorted([(i, t) for i, t, _ in first.values() for _ in range(copies[i])], key=str)


def lines_brute_in_order(rows):
    """The kept text of each row, in the order of the rows (``brute`` sorts)."""
    whole = defaultdict(list)
    for i, t, n, _ in lines_brute(rows):
        whole[i, n].append(t)
    for i, t in rows:
        own = whole[i, (t or "").count("\n") + 1]
        yield max(own, key=lambda x: (x == (t or ""), len(set(x.split("\n")) & set((t or "").split("\n")))))


def test_odd_and_empty_tables(spark, tmp_path):
    from helpers import empty_docs, odd_docs
    from spanshade.llm import quality
    from spanshade.llm.queries import quality_model

    labels = spark.createDataFrame([(7, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    for k, docs in enumerate((odd_docs(spark), empty_docs(spark))):
        path = str(tmp_path / f"in{k}")
        docs.write.parquet(f"{path}/documents.parquet")
        labels.write.parquet(f"{path}/labels.parquet")
        docs = spark.read.parquet(f"{path}/documents.parquet")
        out = corpus_pipeline.run(spark, path)
        assert out.columns == ["doc_id", "lang", "source", "ids", "decoded", "n_tokens"]
        got = sorted(((r.doc_id, r.decoded) for r in out.collect()), key=str)
        if k == 1:
            assert got == []
            continue
        scored = {r.text: r.predicted for r in quality.score(docs, quality_model(docs, labels)).collect()}
        want = plain(docs.collect(), scored)
        sized = [x for x in want if x[1].split()]
        assert sized and [x for x in got if x[1].split()] == sized
