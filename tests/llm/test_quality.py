import numpy as np
import pytest
from helpers import empty_docs, odd_docs
from pyspark.sql import functions as F

from spanshade.llm import quality as q


def test_learns_the_order_of_pairs():
    rng = np.random.RandomState(0)
    good, bad = rng.randn(300, 40), rng.randn(300, 40)
    good[:, 3] += 2
    bad[:, 7] += 1.5
    m = q.BradleyTerry(good, bad)
    z = lambda x: ((x[:, m.used] - m.mean) / m.std) @ m.w
    up, down = z(good), z(bad)
    assert (up[:, None] > down[None, :]).mean() > 0.95
    assert down.mean() < m.cut < up.mean() and 0 < m.quantile < 1


def test_features_against_a_plain_count():
    table = q._shape_table()
    text = "Ab, c9!\nÉé 日"
    shapes = [table[ord(c)] for c in text]
    want = np.zeros(q.SHAPES ** 2)
    for a, b in zip(shapes, shapes[1:]):
        want[int(a) * q.SHAPES + int(b)] += 1
    x = q.features(["", text, "x"], table)
    assert np.allclose(x[1, :-q.EXTRA] ** 2 * (len(text) - 1), want, atol=1e-4)
    assert not x[0].any() and not x[2].any()


def test_odd_rows_and_empty(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(7, 1, 0), (8, 1, 0), (9, 0, None), (10, 0, 1), (10, 0, 1), (None, 1, 1), (12, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = q.train(docs, labels, F.lit(True))
    out = q.score(docs.withColumn("score", F.lit("clash")), model)
    assert out.columns == [*docs.columns, "score", "predicted"]
    rows = out.collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= q.CUT) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 15 or not r.text}) == 2  # null and empty alike
    nothing = q.train(empty_docs(spark), labels.limit(0), F.lit(True))
    assert q.score(empty_docs(spark), nothing).collect() == []
    assert {r.predicted for r in q.score(docs, nothing).collect()} == {1}


def test_sample_is_bounded(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(q, "BradleyTerry", lambda good, bad: taken.append((len(good), len(bad))))
    docs = spark.createDataFrame([(1, f"A good text, number {i}.") for i in range(3000)] + [(2, "bad bad")] * 3000 + [(3, "so-so")],
                                 "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)] * 50, "doc_id long, quality int")
    q.train(docs, labels, F.lit(True), per_label=20)
    assert taken[0][0] == 40 and 1 <= taken[0][1] <= 2


def test_fit_and_scores_against_plain_formulas():
    """The fit lowers the pairwise loss it is meant to lower, and the score is the logistic of the scaled margin."""
    rng = np.random.RandomState(1)
    good, bad = np.abs(rng.randn(60, 12)) + 0.3 * (np.arange(12) < 3), np.abs(rng.randn(60, 12))
    m = q.BradleyTerry(good, bad)
    every = np.concatenate([good, bad])
    scaled = lambda x: (x[:, m.used] - every[:, m.used].mean(0)) / (every[:, m.used].std(0) + 0.02)

    def loss(w):
        return np.mean([np.log1p(np.exp(-(a - b) @ w)) for a in scaled(good) for b in scaled(bad)])

    assert loss(m.w) < 0.9 * loss(np.zeros_like(m.w))
    for step in np.eye(len(m.w)) * 0.5:  # near a minimum: no big step along an axis helps much
        assert min(loss(m.w + step), loss(m.w - step)) > loss(m.w) - 0.01
    up, down = scaled(good) @ m.w, scaled(bad) @ m.w
    best = max(((up >= c).mean() + (down < c).mean()) for c in np.concatenate([up, down]))
    assert (up >= m.cut).mean() + (down < m.cut).mean() >= best - 0.05


def test_held_out_accuracy(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.01"
    try:
        labels = spark.read.parquet(f"{sf}/labels.parquet")
    except Exception:
        pytest.skip("test tables not present")
    got = E.queries()["op8_quality"](spark, sf).where("held_out").join(labels, "doc_id").where("quality is not null")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.95


def test_invalid_utf8(spark):
    docs = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert q.score(docs, q.train(docs, labels, F.lit(True))).first().predicted == 1
