"""Regex detection with code-point offsets, as native Spark expressions.

For one pattern ``p`` over text ``t``::

    m = regexp_extract_all(t, p, 0)       # the matches, left to right
    g = split(t, p, -1)                   # the text between them (len(m)+1 pieces)
    end(i)   = sum(len(g[0..i])) + sum(len(m[0..i]))
    start(i) = end(i) - len(group(i))     # the group is a suffix of the match

In practice one ``regexp_replace`` per pattern marks every match and its
group with control characters and literal ``split``s recover gaps, matches
and groups, so every regex runs once per row (see ``with_candidates``). A cheap necessary condition per
pattern (an ``@``, a digit, a comma...) skips the regex on rows that cannot
match. Everything runs in the JVM; detection is a narrow (shuffle-free)
projection, so it scales with the number of input partitions.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import (
    DEFAULT_CONFIDENCE,
    FALSE_POSITIVES,
    FOLDED_LETTERS,
    MIN_ENTITY_CHARS,
    PiiPattern,
    select_patterns,
)
from ..functions.text import _NON_SPACE_RE, col_of, is_blank, stripped_re
from .entities import INTERNAL_TYPE, RANK_STRIDE, empty_array, to_public
from .merge import resolve_overlaps

_TMP = "__ss_"


def _guard(t: Column, p: PiiPattern, has_digit: Column) -> Column | None:
    if p.guard is None:
        return None
    if p.guard == "digit":
        return has_digit
    if isinstance(p.guard, tuple):
        low = F.col(f"{_TMP}low")
        return functools.reduce(lambda a, b: a | b, [low.contains(lead) for lead in p.guard] + [F.col(f"{_TMP}folded")])
    return t.contains(p.guard)


# Marker character for the one-pass form (see ``_detect``) and the
# character it is replaced by in the scanned copy of a text.
_MARK, _SAFE = "\u0000", "\u0001"


def _select_replacing(df: DataFrame, outputs: dict, drop=()) -> DataFrame:
    """One projection: keep ``df``'s columns (replacing those named in
    ``outputs``), append the new ones, drop ``drop``."""
    drop = set(drop)
    cols = []
    for c in df.columns:
        if c in drop:
            continue
        cols.append(outputs[c].alias(c) if c in outputs else F.col(f"`{c}`"))
    cols += [e.alias(n) for n, e in outputs.items() if n not in df.columns]
    return df.select(*cols)


def _detect(df: DataFrame, text_col, out_col: str, extra=None, *, types=None, patterns=None,
            confidence: float = DEFAULT_CONFIDENCE, guards: bool = True,
            resolve: bool = True, public: bool = True) -> DataFrame:
    """Detection for one text column, in a few projections.

    ``extra``: an optional Column of internal-layout entities merged before
    overlap resolution.

    One regex pass per pattern and text: ``regexp_replace`` puts the marker
    U+0000 before and after every match (and after its span group), and one
    single-character ``split`` yields gap, match[, group] pieces at a fixed
    stride. A U+0000 already in the text is first mapped to U+0001 in the
    scanned copy: one code point and one byte for one, so offsets are
    unchanged, and no catalogue pattern matches either character, so the
    matches are unchanged too.
    """
    pats = tuple(select_patterns(types, patterns))
    conf = float(confidence)
    scan = f"{_TMP}scan"
    staged = {scan: _scan_expr(text_col)}
    if extra is not None:  # under a fixed name, so what follows is built once
        staged[f"{_TMP}extra"] = extra
    if guards and any(p.guard == "digit" for p in pats):  # asked for once, not once per pattern
        staged[f"{_TMP}digit"] = col_of(text_col).rlike(r"(?U)\d")
    if guards and any(isinstance(p.guard, tuple) for p in pats):
        staged[f"{_TMP}low"] = F.lower(col_of(text_col))
        staged[f"{_TMP}folded"] = functools.reduce(lambda a, b: a | b, [col_of(text_col).contains(c) for c in FOLDED_LETTERS])
    d = df.withColumns(staged)
    stage1 = _stage1_exprs(pats, guards)
    d = d.withColumns(stage1) if stage1 else d
    stage2 = _stage2_exprs(pats)
    d = d.withColumns(stage2) if stage2 else d
    if not resolve:
        out = _candidates_expr(0, pats, conf)
    elif extra is None:
        out = _kept_expr(0, pats, conf, public)
    else:
        out = _kept_expr(0, pats, conf, public, f"{_TMP}extra")
    return _select_replacing(d, {out_col: out}, drop=[*staged, *stage1, *stage2])


_SCAN_CACHE: dict = {}


def _scan_expr(text_col) -> Column:
    """The scanned copy: U+0000 mapped to U+0001 (only when present). Kept per
    column name; a Column is built anew (its text does not identify it)."""
    if not isinstance(text_col, str):
        t = col_of(text_col)
        return F.when(t.contains(_MARK), F.translate(t, _MARK, _SAFE)).otherwise(t)
    if text_col not in _SCAN_CACHE:
        if len(_SCAN_CACHE) > 256:
            _SCAN_CACHE.clear()
        _SCAN_CACHE[text_col] = _scan_expr(col_of(text_col))
    return _SCAN_CACHE[text_col]


@functools.lru_cache(maxsize=64)
def _stage1_exprs(pats: tuple, guards: bool) -> dict:
    """One ``regexp_replace`` per pattern marking the matches (guarded)."""
    u = F.col(f"{_TMP}scan")
    blank = is_blank(u)
    has_digit = F.col(f"{_TMP}digit")
    out = {}
    for p in pats:
        cond = ~blank
        gd = _guard(u, p, has_digit) if guards else None
        if gd is not None:
            cond = cond & gd
        repl = _MARK + "$0" + _MARK + (f"${p.group}" + _MARK if p.group else "")
        out[f"{_TMP}k0_{p.ordinal}"] = F.when(
            cond, F.regexp_replace(u, F.lit(p.java_regex), F.lit(repl)))
    return out


@functools.lru_cache(maxsize=64)
def _stage2_exprs(pats: tuple) -> dict:
    """Pieces are read by position inside the fold, so they are their own
    column (a lambda would otherwise re-evaluate the split per element); the
    marked text is longer than the text iff something matched."""
    u = F.col(f"{_TMP}scan")
    out = {}
    for p in pats:
        k = F.col(f"{_TMP}k0_{p.ordinal}")
        out[f"{_TMP}p0_{p.ordinal}"] = F.when(F.octet_length(k) > F.octet_length(u),
                                              F.split(k, _MARK, -1))
    return out


# The per-field expressions only name the staged columns (``__ss_p<i>_<ord>``),
# so they are the same Column for every DataFrame and are built once per
# process: constructing their few thousand nodes through the Python-JVM bridge
# costs seconds, reusing them costs nothing.
def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let_sql(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to the value, evaluated once and not copied (see ``text.let``)."""
    return f"aggregate(CAST(array() AS array<int>), {value}, ({name}, none) -> {name}, {name} -> {body})"


#: Numbers per block of a running sum.
RUN = 16


def _running_sql(v: str, level: int = 2) -> str:
    """SQL text of the running sums of the array of longs named ``v``.

    An ``aggregate`` that collects its sums copies them at every step. So each
    sum is taken from the start of its block of ``RUN`` numbers, and the blocks
    are summed up the same way, ``level`` times."""
    def own(of, start):
        return (f"transform({of}, (x{level}, i{level}) -> aggregate(slice({of}, 1, i{level} + 1), {start}, "
                f"(a{level}, y{level}) -> a{level} + y{level}))")

    if not level:
        return own(v, "0L")
    c, w, totals, ends = (f"{n}{level}" for n in ("c", "w", "t", "e"))
    blocks = f"sequence(0, CAST((size({v}) - 1) DIV {RUN} AS INT))"
    block = f"slice({v}, {c} * {RUN} + 1, {RUN})"
    sums = f"transform({blocks}, {c} -> aggregate({block}, 0L, (a{level}, y{level}) -> a{level} + y{level}))"
    inner = f"IF({c} = 0, 0L, {ends}[{c} - 1])"
    parts = f"flatten(transform({blocks}, {c} -> {_let_sql(w, block, own(w, inner))}))"
    return (f"CASE WHEN size({v}) <= {RUN} THEN {own(v, '0L')} ELSE "
            f"{_let_sql(totals, sums, _let_sql(ends, _running_sql(totals, level - 1), parts))} END")


def _pattern_entities_sql(p: PiiPattern, pieces_col: str, confidence: float) -> str:
    """SQL text of ``filter(fold(pieces), keep)`` for one pattern.

    With one marker around each match (and after its span group) the pieces
    come at a fixed stride: ``gap, match[, group]`` per match, then the tail.
    The lengths of gap and match (code points and UTF-8 bytes) are summed up
    block by block, so the work is linear, and every entity is built once, from
    its sum; the filter drops spans that are shorter than 2 characters once
    stripped (only where a pattern can produce them) and known false positives.
    Written as SQL text so the JVM builds the expression in one call."""
    stride = 3 if p.group else 2
    pc = f"`{pieces_col}`"
    gap = f"element_at({pc}, z * {stride} + 1)"
    m = f"element_at({pc}, z * {stride} + 2)"
    x = f"element_at({pc}, z * {stride} + 3)" if p.group else m
    # bytes in the upper half of a long, code points in the lower: one sum for both
    width = f"(octet_length({gap}) + octet_length({m})) * {1 << 32} + length({gap}) + length({m})"
    end, bend = f"CAST(at & {(1 << 32) - 1} AS INT)", "CAST(shiftright(at, 32) AS INT)"
    ent = (f"named_struct('start_pos', {end} - length({x}), "
           f"'rank', CAST({p.ordinal * RANK_STRIDE} AS BIGINT) + z, "
           f"'end_pos', {end}, 'text', {x}, "
           f"'entity_type', {_sql_str(p.entity_type)}, "
           f"'confidence', CAST({float(confidence)!r} AS DOUBLE), 'source', 'REGEX', "
           f"'byte_start', {bend} - octet_length({x}), 'byte_end', {bend})")
    widths = f"transform(sequence(0, CAST(size({pc}) DIV {stride} AS INT) - 1), z -> {width})"
    found = _let_sql("ws", widths, f"transform({_running_sql('ws')}, (at, z) -> {ent})")
    fold = f"CASE WHEN size({pc}) >= {stride} THEN {found} ELSE CAST(array() AS array<{INTERNAL_TYPE}>) END"
    conds = []
    if p.may_be_short:
        conds.append(f"e.text RLIKE {_sql_str(stripped_re(MIN_ENTITY_CHARS))}")
    fps = tuple(dict.fromkeys(v.lower() for v in FALSE_POSITIVES.get(p.entity_type, ())))
    if fps:
        conds.append(f"NOT lower(e.text) IN ({', '.join(_sql_str(v) for v in fps)})")
    if not conds:
        return fold
    return f"filter({fold}, e -> {' AND '.join(conds)})"


@functools.lru_cache(maxsize=256)
def _candidates_expr(i: int, pats: tuple, confidence: float) -> Column:
    per_pattern = [F.expr(_pattern_entities_sql(p, f"{_TMP}p{i}_{p.ordinal}", confidence))
                   for p in pats]
    if not per_pattern:
        return empty_array(INTERNAL_TYPE)
    return per_pattern[0] if len(per_pattern) == 1 else F.concat(*per_pattern)


@functools.lru_cache(maxsize=256)
def _kept_expr(i: int, pats: tuple, confidence: float, public: bool, extra_col: str | None = None) -> Column:
    cands = _candidates_expr(i, pats, confidence)
    if extra_col is not None:
        cands = F.concat(cands, F.coalesce(F.col(extra_col), empty_array(INTERNAL_TYPE)))
    return resolve_overlaps(cands, extra_col is not None, **({"view": to_public} if public else {}))


def with_candidates(df: DataFrame, text_col, out_col: str = "candidates", *,
                    types=None, patterns=None, confidence: float = DEFAULT_CONFIDENCE,
                    guards: bool = True) -> DataFrame:
    """Add ``out_col``: raw regex candidates (internal layout) in catalogue order.

    Candidates are validated (stripped length >= 2, not a known false
    positive) but not yet deduplicated.
    """
    return _detect(df, text_col, out_col, types=types, patterns=patterns, confidence=confidence, guards=guards, resolve=False)


def with_entities(df: DataFrame, text_col, out_col: str = "entities", *, types=None,
                  patterns=None, confidence: float = DEFAULT_CONFIDENCE,
                  extra=None, public: bool = True, guards: bool = True) -> DataFrame:
    """Regex detection + overlap resolution (the regex-only detector).

    ``extra`` is an optional Column of internal-layout entities from other
    sources (already ranked after the regex lists), merged before resolution.
    The result is sorted by start; public layout unless ``public=False``.
    """
    return _detect(df, text_col, out_col, extra, types=types, patterns=patterns, confidence=confidence, guards=guards,
                   public=public)


def _sql_text(v: str) -> str:
    """A SQL literal of ``v``, control characters escaped."""
    return "".join(f"\\u{ord(c):04x}" if c < " " else c for c in _sql_str(v))


def _text_pattern_sql(p: PiiPattern, guards: bool, confidence: float) -> str:
    """One pattern's entities in the scanned text ``u`` (``dg``: it has a digit)."""
    none = f"CAST(array() AS array<{INTERNAL_TYPE}>)"
    repl = _MARK + "$0" + _MARK + (f"${p.group}" + _MARK if p.group else "")
    marked = f"regexp_replace(u, {_sql_text(p.java_regex)}, {_sql_text(repl)})"
    pieces = _let_sql("k", marked, f"CASE WHEN octet_length(k) > octet_length(u) THEN split(k, {_sql_text(_MARK)}, -1) END")
    found = _let_sql("pc", pieces, _pattern_entities_sql(p, "pc", confidence))
    if not guards or p.guard is None:
        return found
    if isinstance(p.guard, tuple):
        guard = " OR ".join(["folded", *[f"contains(low, {_sql_text(lead)})" for lead in p.guard]])
    else:
        guard = "dg" if p.guard == "digit" else f"contains(u, {_sql_text(p.guard)})"
    return f"CASE WHEN {guard} THEN {found} ELSE {none} END"


@functools.lru_cache(maxsize=64)
def _texts_candidates(texts_col: str, pats: tuple, guards: bool, confidence: float) -> Column:
    none = f"CAST(array() AS array<{INTERNAL_TYPE}>)"
    every = ", ".join(_text_pattern_sql(p, guards, confidence) for p in pats)
    scan = f"CASE WHEN contains(t, {_sql_text(_MARK)}) THEN translate(t, {_sql_text(_MARK)}, {_sql_text(_SAFE)}) ELSE t END"
    found = f"concat({every})"
    if guards and any(isinstance(p.guard, tuple) for p in pats):
        folded = " OR ".join(f"contains(u, '{c}')" for c in FOLDED_LETTERS)
        found = _let_sql("low", "lower(u)", _let_sql("folded", folded, found))
    found = _let_sql("u", scan, _let_sql("dg", "u RLIKE '(?U)\\\\d'", found)) if pats else none
    return F.expr(f"transform(`{texts_col}`, t -> CASE WHEN t IS NULL OR NOT t RLIKE {_sql_text(_NON_SPACE_RE)} "
                  f"THEN {none} ELSE {found} END)")


@functools.lru_cache(maxsize=64)
def _texts_kept(cands_col: str, extra_col: str | None) -> Column:
    if extra_col is None:
        return F.transform(cands_col, lambda c: resolve_overlaps(c, may_have_empty=False, view=to_public))
    return F.zip_with(cands_col, extra_col, lambda c, x: resolve_overlaps(
        F.concat(c, F.coalesce(x, empty_array(INTERNAL_TYPE))), may_have_empty=True, view=to_public))


def with_entities_of_texts(df: DataFrame, texts_col: str, out_col: str, extra_col: str | None = None, *,
                           types=None, patterns=None, confidence: float = DEFAULT_CONFIDENCE,
                           guards: bool = True) -> DataFrame:
    """``with_entities`` over an array of texts: ``out_col`` has one entity array per text.

    One expression walks the array, so the plan is the same for any number of
    texts, and it is built once per process. ``extra_col``: an array of the
    same length with internal-layout entities (or NULL) to merge. A NULL text
    has no entities of its own.
    """
    cands = f"{_TMP}cands"
    pats = tuple(select_patterns(types, patterns))
    d = df.withColumn(cands, _texts_candidates(texts_col, pats, guards, float(confidence)))
    return _select_replacing(d, {out_col: _texts_kept(cands, extra_col)}, drop=[cands])


def detect_table(df: DataFrame, key_cols, text_col, **kw) -> DataFrame:
    """Long form: one row per kept entity ``(keys..., text, entity_type, start_pos,
    end_pos, confidence, source)``."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    d = with_entities(df.select(*keys, col_of(text_col).alias("__text")), "__text", "__e", **kw)
    return explode_entities(d, keys, "__e")


def explode_entities(df: DataFrame, keys, col: str) -> DataFrame:
    """One row per array element, struct fields as columns.

    Uses ``inline_outer`` and filters above the generator: a plain ``explode``
    makes Catalyst infer ``size(col) > 0`` and push it below the projection
    that computes ``col``, which would run the detection twice.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df.select(*keys, F.inline_outer(col))
    first = out.columns[len(keys)]
    return out.where(F.col(first).isNotNull())
