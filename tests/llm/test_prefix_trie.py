import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanshade.llm import oracle
from spanshade.llm import prefix_trie as pt
from spanshade.llm.common import staged
from spanshade.llm.queries import op12_prefix_trie, rebuilt_turns

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(str(len(role)).encode() + b":" + role + text).hexdigest()


def ordered(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn is not None, turn or 0, digest(role, text), (role or "", text or "")))
    return {c: [t[3] for t in sorted(ts)] for c, ts in out.items()}


def rebuilt(rows):
    own = ordered(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[b] for b in below)
    ends = {node: ",".join(str(c) for c in sorted(members[node]) if len(convs[c]) == len(node)) for node in members}
    return {(min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n],
             saved[n], hashlib.sha256(ends[n].encode()).hexdigest()) for n in members}


def got(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_rows(seed, convs, longest, says):
    rng = random.Random(seed)
    return [(c, t, rng.choice(("user", "assistant", None)), rng.choice(says)) for c in rng.sample(range(-convs, 3 * convs), convs)
            for t in range(rng.randint(1, longest))]


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(pt, "LEAST_ROWS", 1)
    monkeypatch.setattr(pt, "PIECE_BYTES", 5)


def trie(spark, rows, range_rows):
    turns = staged(pt.ordered_turns(table(spark, rows), range_rows=range_rows), "test-ordered")
    return pt.prefix_trie(*rebuilt_turns(turns), range_rows=range_rows)


@pytest.mark.parametrize("range_rows", [30, 100_000])
def test_against_plain_python(spark, small_ranges, range_rows):
    rows = random_rows(1, 80, 12, ("a", "é", "", None))
    rows += [(1000 + k, 0, "user", "the same start") for k in range(40)]  # rebuilt: many turnless ones too
    assert got(trie(spark, rows, range_rows)) == plain(rebuilt(rows))


def test_one_conversation_over_many_ranges(spark, small_ranges):
    rows = [(5, t, "user", f"turn {t % 3}") for t in range(300)]
    rows += [(c, t, "user", f"turn {t % 3}") for c in (6, 7, 8, 10, 15) for t in range(40)]
    assert got(trie(spark, rows, 25)) == plain(rebuilt(rows))


def test_equal_conversations_end_at_one_node(spark, small_ranges):
    rows = [(5 * k, t, "user", text) for k in range(200) for t, text in enumerate(("hello", "there"))]
    out = got(trie(spark, rows, 30))
    assert out == plain(rebuilt(rows)) and len(out) == 3


def test_null_turns_ties_and_repeated_rows(spark):
    rows = [(5, None, None, None), (5, 2, "user", "b"), (5, 2, "user", "a"), (5, 2, "user", "a"), (5, -1, "", ""),
            (None, 1, "user", "no conversation"), (6, 1, "x", "y" * 100_000), (-3, 1, "user", "below zero")]
    want = plain(rebuilt(rows))
    assert got(trie(spark, rows, 1 << 19)) == want
    assert got(trie(spark, rows[::-1], 1 << 19)) == want


def test_role_and_text_do_not_run_together(spark):
    rows = [(0, 1, "ab", "c"), (5, 1, "a", "bc"), (10, 1, "1:a", "b"), (15, 1, "1", ":ab")]
    assert len([r for r in got(trie(spark, rows, 1 << 19)) if r[1] == 1]) == 4


def test_empty(spark):
    assert trie(spark, [], 1 << 19).collect() == []
    assert trie(spark, [(None, 1, "user", "x")], 1 << 19).collect() == []


def test_without_turns_there_is_the_root(spark):
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    rows = [(c, 1, "user", "replaced by nothing")]
    assert got(trie(spark, rows, 1 << 19)) == plain(rebuilt(rows)) == {
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1000), st.none()), max_size=200), st.integers(2, 9))
def test_queue_gives_what_a_sorted_list_gives(ops, limit):
    queue, held = pt.SpillingQueue(limit), []
    queue.BLOCK = 3
    for x in ops:
        if x is not None:
            queue.push((x, -x, 0, 1, 2))
            held.append((x, -x, 0, 1, 2))
        elif held:
            held.sort()
            assert queue.first() == held[0]
            assert queue.pop() == held.pop(0)
    for e in sorted(held):
        assert queue.pop() == e
    assert queue.first() is None


def test_spilling_does_not_change_totals(spark, small_ranges):
    rows = random_rows(4, 150, 5, ("a", "b", "c"))
    turns, convs = rebuilt_turns(staged(pt.ordered_turns(table(spark, rows)), "test-ordered"))
    once = pt.prefix_trie(turns, convs, range_rows=1 << 19)
    nodes = once.selectExpr("conv_id conv", "depth", "parent_conv_id up", "0L hi", "0L lo", "n_convs n",
                            "if(n_children = 0, 1L, 0L) leaves", "conv_id * 3 + depth saved")
    want = set(map(tuple, pt.subtree_totals(nodes, 1 << 19).collect()))
    assert set(map(tuple, pt.subtree_totals(nodes, 20, queue_rows=2).collect())) == want


def test_query_and_sql(spark, tmp_path):
    rows = random_rows(7, 60, 9, ("a", "b ü", None, "")) + [(5, None, "user", "first"), (5, 3, None, None), (5, 3, None, "")]
    table(spark, rows).selectExpr("*", "'clash' as depth").write.parquet(f"{tmp_path}/conversations.parquet")
    want = plain(rebuilt(rows))
    assert got(op12_prefix_trie(spark, str(tmp_path))) == want
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    rel = con.sql(oracle.SQL["op12_prefix_trie"])
    at = [rel.columns.index(c) for c in COLUMNS]
    assert {tuple(r[i] for i in at) for r in rel.fetchall()} == want
