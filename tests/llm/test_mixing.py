import hashlib

from helpers import empty_docs, odd_docs, words

from spanshade.llm.mixing import mix

OWN = ["size", "source_size", "target", "copies", "taken"]


def brute(rows):
    size = [len(words(t)) for _, t, _ in rows]
    place = [int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16) for i, _, _ in rows]
    per = {}
    for (_, _, s), n in zip(rows, size):
        per[s] = per.get(s, 0) + n
    order = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(per.values()), set(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] >= 2 * per[s]}
        for s in full or open_:
            target[s] = 2 * per[s] if full else unit * weight[s]
            left -= target[s] if full else 0
        if not full:
            break
        open_ -= full
    out = []
    for s in order:
        own = [k for k, r in enumerate(rows) if r[2] == s]
        epochs = int(target[s] // per[s]) if per[s] else 0
        budget = target[s] - epochs * per[s]
        best, past = -1, 0
        for h in sorted({place[k] for k in own}):
            through = past + sum(size[k] for k in own if place[k] == h)
            if through >= budget:
                best = h if through - budget < budget - past else h - 1
                break
            past = through
        out += [(rows[k][0], size[k], per[s], round(target[s], 6), (epochs + (place[k] <= best if per[s] else 0)) * size[k])
                for k in own]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken)
                   for r in df.select("doc_id", *OWN).collect()), key=str)


def test_against_brute_force(spark):
    more = [(100 + i, "w " * (i % 37)) for i in range(300)] + [(50, "q " * 5000), (130, "r r r")]
    docs = odd_docs(spark, more)
    out = mix(docs)
    assert out.columns == [*docs.columns, *OWN]
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert got(out) == brute(rows)
    assert got(mix(docs.repartition(7))) == got(out)  # reruns agree


def test_clashing_columns_and_empty(spark):
    from pyspark.sql import functions as F

    docs = odd_docs(spark).withColumn("size", F.lit("x")).withColumn("key", F.lit("kept"))
    out = mix(docs)
    assert {r.key for r in out.collect()} == {"kept"} and dict(out.dtypes)["size"] == "bigint"
    assert mix(empty_docs(spark)).collect() == []


def test_targets_over_many_ranges(spark):
    """No task takes all sources: only sums of ranges, one row each, pass through one."""
    from pyspark.sql import functions as F

    from spanshade.llm import mixing

    rows = [(f"s{i}", f"n{i * 7919 % 3001:05d}", i % 41) for i in range(3001)] + [("n", None, 90)]
    sizes = spark.createDataFrame(rows, "key string, source string, size long")
    spread = []
    staged = mixing.staged

    def watched(df, name, *by):
        out = staged(df, name, *by)
        if name in ("mix-names", "mix-ratios"):
            spread.append(sorted(r["count"] for r in out.groupBy("range").count().collect()))
        return out

    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    mixing.staged = watched
    try:
        got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    finally:
        mixing.staged = staged
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(spread) == 2 and all(len(n) > 4 and n[-1] < 1500 for n in spread)
    per = {s: n for _, s, n in rows}
    order = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, want = 1.5 * sum(per.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] >= 2 * per[s]}
        for s in full or open_:
            want[s] = 2 * per[s] if full else unit * weight[s]
            left -= want[s] if full else 0
        if not full:
            break
        open_ -= full
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
    assert mixing.targets(sizes.where(F.lit(False))).count() == 0
