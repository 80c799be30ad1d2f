"""Small Column helpers shared by detection, redaction and reporting.

All are native Spark expressions (no Python on the executors).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set: Unicode White_Space plus the four ASCII
# separators U+001C..U+001F, which Java's (?U)\s does not include.
_SPACE_CLASS = r"[\s\x{1C}-\x{1F}]"
_STRIP_RE = r"(?U)^" + _SPACE_CLASS + r"+|" + _SPACE_CLASS + r"+$"
_NON_SPACE_RE = r"(?U)[^\s\x{1C}-\x{1F}]"


def stripped_re(least: int) -> str:
    """Matches a text that has ``least`` (2 or more) characters once stripped."""
    return _NON_SPACE_RE + "(?s:.{" + str(least - 2) + ",}?)" + _NON_SPACE_RE[len("(?U)"):]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once.

    The finish of an ``aggregate`` over no elements: ``transform`` and
    ``aggregate`` copy what their functions return (whole texts and lists, once
    per nested ``let``), the finish is handed on as it is.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, body)


def ustrip(c) -> Column:
    """Unicode whitespace strip (``str.strip()``); Spark's ``trim`` only removes spaces."""
    return F.regexp_replace(col_of(c), F.lit(_STRIP_RE), F.lit(""))


def is_blank(c) -> Column:
    """True for NULL, empty or whitespace-only text."""
    c = col_of(c)
    return c.isNull() | ~c.rlike(_NON_SPACE_RE)


def preview(c, n: int = 50, always_dots: bool = False) -> Column:
    """First ``n`` characters plus ``...`` (conditional unless ``always_dots``)."""
    c = col_of(c)
    head = F.concat(F.substring(c, 1, n), F.lit("..."))
    if always_dots:
        return head
    return F.when(F.length(c) > n, head).otherwise(c)


def digits(c) -> Column:
    """Keep only decimal digits (Unicode Nd, like ``str.isdigit`` on regex matches)."""
    return F.regexp_replace(col_of(c), F.lit(r"(?U)\D"), F.lit(""))


def clock() -> Column:
    """The clock of the task (microseconds since the epoch), read anew for every row."""
    return F.expr("unix_micros(cast(reflect('java.time.Instant', 'now') as timestamp))")
