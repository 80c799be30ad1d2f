import random

import numpy as np
import xxhash
from helpers import ascii_lower, empty_docs, odd_docs, words

from spanshade.llm import simhash


def fingerprint(text):
    w = words(ascii_lower(text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, radius=4):
    """Label of each fingerprint by flooding."""
    label, n = {}, 0
    for f in fps:
        if f in label:
            continue
        label[f], front, n = n, [f], n + 1
        while front:
            x = front.pop()
            for y in fps:
                if y not in label and (x ^ y).bit_count() <= radius:
                    label[y] = label[f]
                    front.append(y)
    return label


def test_masks_cover_every_pair():
    masks = simhash.covering_masks(4)
    rng = random.Random(1)
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(diff & m == 0 for m in masks)


def test_groups_against_brute_force(spark):
    rng = random.Random(2)
    vocab = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.choice([3, 30, 300]))) for _ in range(60)]
    more = []
    for k, t in enumerate(texts):  # chains of near copies
        for c in range(4):
            w = t.split()
            w[rng.randrange(len(w))] = rng.choice(vocab)
            t = " ".join(w)
            more.append((1000 + 10 * k + c, t))
    docs = odd_docs(spark, more)
    rows = docs.collect()
    label = classes(sorted({fingerprint(r.text) for r in rows}))
    low = {}
    for r in rows:
        k = label[fingerprint(r.text)]
        if r.doc_id is not None:
            low[k] = min(low.get(k, r.doc_id), r.doc_id)
    want = sorted(((r.doc_id, f"{fingerprint(r.text):016x}", low.get(label[fingerprint(r.text)])) for r in rows), key=str)
    got = simhash.near_groups(docs.withColumnRenamed("n_chars", "fp"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert sorted(label[fingerprint(r.text)] for r in kept) == sorted(set(label.values()))
    assert {r.doc_id for r in kept if r.doc_id is not None} == set(low.values())


def test_dense_and_split_buckets(spark):
    rng = np.random.RandomState(3)
    base = rng.randint(0, 1 << 62, 12)
    fps = sorted({int(b) ^ sum(1 << int(k) for k in rng.choice(14, rng.randint(0, 7), replace=False)) for b in base for _ in range(120)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = classes(fps)
    for block in (2048, 8):
        roots = {r.node: r.root for r in simhash.components(simhash.links(df, 4, block)).collect()}
        mine = [roots.get(f, f) for f in fps]
        assert len(set(mine)) == len(set(want.values()))
        assert len({(a, want[f]) for a, f in zip(mine, fps)}) == len(set(mine))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_empty(spark):
    assert simhash.near_groups(empty_docs(spark)).collect() == []
    assert simhash.keep_one(empty_docs(spark)).collect() == []
