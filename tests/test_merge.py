"""Overlap resolution: hand-derived cases, properties of the result, and cost."""

import random
import time

from pyspark.sql import functions as F

from spanshade.operators.detect import with_entities
from spanshade.operators.entities import INTERNAL_TYPE
from spanshade.operators.merge import BLOCK, resolve_overlaps


def _resolve(spark, lists):
    rows = [(li, [(s, i, e, f"t{i}", "X", c, "REGEX", -1, -1) for i, (s, e, c) in enumerate(ents)])
            for li, ents in enumerate(lists)]
    df = spark.createDataFrame(rows, f"id int, c array<{INTERNAL_TYPE}>")
    out = df.select("id", resolve_overlaps(F.col("c")).alias("k")).orderBy("id").collect()
    return [[(k.start_pos, k.end_pos, k.confidence, k.rank) for k in r.k] for r in out]


# (spans in list order, kept spans), derived by hand from the rule
CASES = [
    ([(0, 5, .8), (3, 9, .9), (9, 12, .8)], [(3, 9), (9, 12)]),
    ([(0, 10, .8), (5, 15, .9), (12, 20, .85)], [(5, 15)]),
    ([(0, 5, .8), (5, 9, .8)], [(0, 5), (5, 9)]),      # touching spans do not overlap
    ([(0, 5, .8), (0, 9, .8)], [(0, 5)]),              # a tie keeps the first
    ([(0, 9, .8), (0, 5, .9)], [(0, 5)]),
    ([(4, 6, .9), (0, 5, .8)], [(4, 6)]),              # list order does not matter, starts do
    ([(0, 5, .8), (2, 2, .9)], [(2, 2)]),              # an empty span inside replaces...
    ([(0, 5, .8), (2, 2, .9), (3, 4, .1)], [(2, 2), (3, 4)]),  # ...and then hides nothing
    ([(0, 5, .8), (2, 2, .7)], [(0, 5)]),
    ([(3, 3, .9), (3, 3, .8), (3, 5, .1)], [(3, 3), (3, 3), (3, 5)]),  # empty spans overlap nothing at their edge
    ([], []),
]


def test_hand_derived_cases(spark):
    got = _resolve(spark, [c for c, _ in CASES])
    assert [[(s, e) for s, e, _, _ in g] for g in got] == [w for _, w in CASES]


def _random_list(rnd, n, width):
    return [(s := rnd.randint(0, width), s + rnd.randint(0, 8), rnd.choice([0.5, 0.8, 0.85, 0.9])) for _ in range(n)]


def test_properties_of_the_result(spark):
    rnd = random.Random(7)
    lists = [_random_list(rnd, rnd.randint(0, 12), 30) for _ in range(200)]
    lists += [_random_list(rnd, rnd.randint(BLOCK - 2, 4 * BLOCK), 700) for _ in range(30)]
    for ents, got in zip(lists, _resolve(spark, lists)):
        kept = [(s, e) for s, e, _, _ in got]
        assert kept == sorted(kept, key=lambda k: k[0])
        wide = [k for k in kept if k[0] < k[1]]
        assert all(a[1] <= b[0] for a, b in zip(wide, wide[1:]))
        chosen = {r for _, _, _, r in got}
        assert len(chosen) == len(got) and all(ents[r] == (s, e, c) for s, e, c, r in got)
        first = min(range(len(ents)), key=lambda i: (ents[i][0], i), default=None)
        for i, (s, e, c) in enumerate(ents):
            if i not in chosen:  # what is dropped overlapped some other span
                assert any(s < y and e > x for j, (x, y, _) in enumerate(ents) if j != i)
        if first is not None and not any(x < ents[first][1] and y > ents[first][0]
                                         for j, (x, y, _) in enumerate(ents) if j != first):
            assert first in chosen


def test_far_apart_groups_are_independent(spark):
    """A long list resolves to its groups' results one after another, wherever blocks end."""
    rnd = random.Random(8)
    groups = [_random_list(rnd, rnd.randint(1, 9), 20) for _ in range(3 * BLOCK)]
    alone = _resolve(spark, groups)
    shifted = [[(s + 100 * g, e + 100 * g, c) for s, e, c in ents] for g, ents in enumerate(groups)]
    whole = _resolve(spark, [[x for ents in shifted for x in ents]])[0]
    want = [(s + 100 * g, e + 100 * g, c) for g, ents in enumerate(alone) for s, e, c, _ in ents]
    assert [(s, e, c) for s, e, c, _ in whole] == want


def test_time_grows_linearly(spark):
    def seconds(n):
        df = spark.createDataFrame([(" ".join(f"u{i}@ex.com" for i in range(n)),)], "text string")
        t = time.time()
        assert with_entities(df, "text", types=["EMAIL"]).select(F.size("entities")).first()[0] == n
        return time.time() - t

    seconds(1000)
    small = min(seconds(16_000) for _ in range(2))
    assert min(seconds(32_000) for _ in range(2)) <= 2.2 * small + 0.5
