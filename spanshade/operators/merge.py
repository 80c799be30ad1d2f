"""Overlap resolution of entity lists (merge + deduplicate).

Semantics: concatenate the lists in argument order, stable-sort by start, then
walk left to right; an entity that overlaps an already kept one replaces it
only when its confidence is strictly greater, otherwise it is dropped; an
entity that overlaps nothing is kept. Overlap is ``a.start < b.end and
a.end > b.start`` (touching spans do not overlap).

Kept non-empty spans are pairwise disjoint with non-decreasing starts and
every incoming start is >= the last of them, so an incoming entity can only
overlap the *last kept non-empty* span; zero-length spans never overlap a
later entity. So the walk holds that one span and never looks further back: no
shuffle, no window, no Python. ``aggregate`` copies its accumulator at every
step, so an accumulator that collects the result would make the walk
quadratic. The array is walked in blocks instead: one pass finds the state
before each block (the place of a single entity and a count), a second walks
each block from its state and collects at most ``BLOCK`` places. States and
results are places in the sorted array, never entities: copying an entity
copies its texts, at every step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let
from .entities import empty_array

#: Entities per block of the walk.
BLOCK = 32


def overlaps(a: Column, b: Column) -> Column:
    """Half-open interval overlap test on two entity structs."""
    return (a["start_pos"] < b["end_pos"]) & (a["end_pos"] > b["start_pos"])


# A kept entity: its start, its place in the kept list, its place in the array.
_KEPT_TYPE = "struct<s:int,i:int,x:int>"
# The last kept non-empty entity (-1: none), its place in the kept list, the places given.
_STATE_TYPE = "struct<last:int,place:int,n:int>"


def _blocks(cands: Column):
    """Block numbers, and the entities of a block."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(cands) - 1) / BLOCK).cast("int"))
    return numbers, lambda c: F.slice(cands, c * BLOCK + 1, F.lit(BLOCK))


def walk_blocks(cands: Column, start: Column, state_type: str, move, leaves, out_type: str, last) -> Column:
    """The walk in two passes: the state before each block, then each block's result.

    ``move(state, e)`` is the next state, ``leaves(state, e)`` what the step
    gives to the result (or NULL), ``last(state)`` what is left at the end.
    """
    numbers, block = _blocks(cands)
    states = F.aggregate(
        numbers, F.struct(start.alias("now"), empty_array(state_type).alias("before")),
        lambda acc, c: F.struct(F.aggregate(block(c), acc["now"], move).alias("now"),
                                F.concat(acc["before"], F.array(acc["now"])).alias("before")),
        lambda acc: F.concat(acc["before"], F.array(acc["now"])))

    def collect(state):
        return lambda c: F.aggregate(
            block(c), F.struct(F.get(state, c).alias("s"), empty_array(out_type).alias("out")),
            lambda acc, e: F.struct(move(acc["s"], e).alias("s"), F.concat(
                acc["out"], F.array_compact(F.array(leaves(acc["s"], e)))).alias("out")),
            lambda acc: acc["out"])

    kept = let(states, lambda st: F.concat(F.flatten(F.transform(numbers, collect(st))),
                                            F.array_compact(F.array(last(F.element_at(st, -1))))))
    return F.when(F.size(cands) > 0, kept).otherwise(empty_array(out_type))


def _places(cands: Column, walk, out_type: str) -> Column:
    """``walk`` over the places of ``cands``."""
    n = F.size(cands)
    return F.when(n > 0, let(F.sequence(F.lit(0), n - 1), walk)).otherwise(empty_array(out_type))


def _walk(cands: Column) -> Column:
    """The walk over non-empty entities: the state is the last kept one (-1: none); gives the places of the kept."""
    def at(i):
        return F.get(cands, i)

    def hit(last, i):
        return (last >= 0) & overlaps(at(i), at(last))

    return _places(cands, lambda places: walk_blocks(
        places, F.lit(-1), "int",
        lambda last, i: F.when(hit(last, i) & (at(i)["confidence"] <= at(last)["confidence"]), last).otherwise(i),
        lambda last, i: F.when((last >= 0) & ~overlaps(at(i), at(last)), last), "int",
        lambda last: F.when(last >= 0, last)), "int")


def _walk_any(cands: Column) -> Column:
    """The walk with empty entities: kept entities with their place in the kept list.

    ``last`` is the last kept non-empty entity (or -1), ``n`` the places given
    so far; an entity that replaces ``last`` takes its place. At most one entity
    leaves: the old last when a non-empty one follows it, or an empty one.
    """
    def at(i):
        return F.get(cands, i)

    def parts(state, i):
        last, e = state["last"], at(i)
        return (last, state["place"], (last >= 0) & overlaps(e, at(last)),
                e["confidence"] > at(last)["confidence"], e["end_pos"] > e["start_pos"])

    def state_of(last, place):
        return F.struct(last.alias("last"), place.alias("place"))

    def move(state, i):
        last, place, hit, wins, wide = parts(state, i)
        old = state_of(last, place)
        new = (F.when(hit, F.when(~wins, old).when(wide, state_of(i, place)).otherwise(state_of(F.lit(-1), F.lit(-1))))
               .when(wide, state_of(i, state["n"])).otherwise(old))
        return let(new, lambda now: F.struct(now["last"].alias("last"), now["place"].alias("place"), (
            state["n"] + F.when(hit, 0).otherwise(1)).alias("n")))

    def kept(i, place):
        return F.struct(at(i)["start_pos"].alias("s"), place.alias("i"), i.alias("x"))

    def leaves(state, i):
        last, place, hit, wins, wide = parts(state, i)
        return (F.when(hit, F.when(wins & ~wide, kept(i, place)))
                .when(wide, F.when(last >= 0, kept(last, place))).otherwise(kept(i, state["n"])))

    start = F.struct(F.lit(-1).alias("last"), F.lit(-1).alias("place"), F.lit(0).alias("n"))
    return _places(cands, lambda places: walk_blocks(
        places, start, _STATE_TYPE, move, leaves, _KEPT_TYPE,
        lambda state: F.when(state["last"] >= 0, kept(state["last"], state["place"]))), _KEPT_TYPE)


def resolve_overlaps(candidates: Column, may_have_empty: bool = True, view=lambda e: e) -> Column:
    """M3 on an internal-layout array; returns the kept entities sorted by start.

    ``candidates`` must already be in list order with ``rank`` set (sorting by
    the struct = stable sort by start). With ``may_have_empty=False`` (regex
    candidates are never empty) the kept list is already in start order.
    ``view`` gives the form of a kept entity.
    """
    if not may_have_empty:
        return let(F.sort_array(candidates), lambda es: F.transform(_walk(es), lambda i: view(F.get(es, i))))
    # by start, then by place in the kept list
    return let(F.sort_array(candidates), lambda es: F.transform(
        F.sort_array(_walk_any(es)), lambda k: view(F.get(es, k["x"]))))


def merge_entity_lists(*arrays: Column, may_have_empty: bool = True) -> Column:
    """UNION ALL of internal-layout arrays in argument order, then M3."""
    return resolve_overlaps(F.concat(*arrays), may_have_empty)
