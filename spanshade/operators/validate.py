"""Validation of redaction results (optional report column).

* every redacted original text still contained (case-insensitively) in the
  redacted text is an error, one message each;
* a redacted text longer than 1.5 times the original is a warning.

Known false alarm kept for parity: a NAME whose text is "name" is contained
in ``[REDACTED_NAME]``.

All different originals of a record are searched together: those of up to
``GRAM`` code points by intersecting the originals of a length with the grams
of that length of the redacted text, the longer ones by intersecting their
first ``GRAM`` code points first; only those that are found so are searched one
by one. The text goes through in windows, so the grams held at once are bounded. So the
work grows with the text and with the originals, not with their product, unless
thousands of different long originals do stand in the redacted text (or long
ones with equal beginnings). Records with up to ``FEW`` originals are searched directly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import col_of
from .merge import let, walk_blocks

VALIDATION_TYPE = "struct<is_valid:boolean,errors:array<string>,warnings:array<string>>"


#: Originals up to this length are found by grams of their own length, longer ones first by grams of this.
GRAM = 24
#: Up to this many different originals are searched one by one: a plain search passes a character about a
#: hundred times as fast as a gram of it is made, and there may be ``GRAM`` lengths of grams.
FEW = 256
#: Code points of the redacted text whose grams are held at once.
WINDOW = 1 << 16


def _grams(window: Column, n: Column) -> Column:
    """All grams of ``n`` code points, overlapping, in one pass of a regex."""
    return F.regexp_extract_all(window, F.concat(F.lit("(?s)(?=(.{"), n.cast("string"), F.lit("})).")), F.lit(1))


def _members(keys: Column, held: Column) -> Column:
    """Places (ascending) of the elements of ``keys`` that are in ``held``: both in one sorted array, walked once."""
    events = F.sort_array(F.concat(
        F.transform(held, lambda h: F.struct(h.alias("k"), F.lit(-1).alias("i"))),
        F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.cast("int").alias("i")))))
    return let(events, lambda es: F.sort_array(walk_blocks(
        es, F.lit(None).cast("string"), "string", lambda last, e: F.when(e["i"] < 0, e["k"]).otherwise(last),
        lambda last, e: F.when((e["i"] >= 0) & (e["k"] == last), e["i"]), "int", lambda last: F.lit(None).cast("int"))))


def _present(low: Column, wanted: Column) -> Column:
    """The texts of ``wanted`` (different, not empty) that stand in ``low``."""
    def of_length(n):
        here = F.filter(wanted, lambda w: F.length(w) == n)
        begins = F.array_distinct(F.transform(F.filter(wanted, lambda w: F.length(w) > GRAM), lambda w: F.substring(w, 1, GRAM)))
        sought = F.when(n == GRAM, F.array_union(here, begins)).otherwise(here)
        last = F.floor((F.length(low) - 1) / WINDOW).cast("int")
        return let(sought, lambda ws: F.aggregate(
            F.sequence(F.lit(0), last), F.array().cast("array<string>"),
            lambda acc, i: F.array_union(acc, F.array_intersect(ws, _grams(F.substring(low, i * WINDOW + 1, n + (WINDOW - 1)), n)))))

    def of_found(found):
        long = let(F.filter(wanted, lambda w: F.length(w) > GRAM), lambda ws: F.transform(
            _members(F.transform(ws, lambda w: F.substring(w, 1, GRAM)), found), lambda i: F.get(ws, i)))
        return F.concat(F.array_intersect(wanted, found), F.filter(long, lambda w: F.contains(low, w)))

    lengths = F.array_distinct(F.transform(wanted, lambda w: F.least(F.length(w), F.lit(GRAM))))
    return F.when(F.length(low) == 0, F.array().cast("array<string>")).otherwise(
        let(F.flatten(F.transform(lengths, of_length)), of_found))


def _leaks(low: Column, records: Column) -> Column:
    """The records whose original stands in ``low``, in order."""
    def among(keys):
        wanted = F.array_distinct(F.array_compact(keys))
        held = let(wanted, lambda ws: F.when(F.size(ws) <= FEW, F.filter(ws, lambda w: F.contains(low, w))).otherwise(
            F.concat(F.filter(ws, lambda w: w == ""), let(F.filter(ws, lambda w: w != ""), lambda us: _present(low, us)))))
        return let(held, lambda hs: F.when(F.size(hs) > 0, F.transform(_members(keys, hs), lambda i: F.get(records, i)))
                   .otherwise(F.slice(records, 1, 0)))

    return let(F.transform(records, lambda x: F.lower(x["original_text"])), among)


def validation(original, redacted, records) -> Column:
    """Validation struct (is_valid, errors[], warnings[]) for one text."""
    o, r, recs = col_of(original), col_of(redacted), col_of(records)
    leaked = let(F.lower(r), lambda low: _leaks(low, recs))
    errors = F.transform(leaked, lambda x: F.concat(
        F.lit("PII text '"), x["original_text"], F.lit("' still present in redacted text")))
    grew = F.length(r) > F.length(o) * F.lit(1.5)
    warnings = F.when(grew, F.array(F.concat(
        F.lit("Redacted text significantly longer than original ("),
        F.length(r).cast("string"), F.lit(" vs "), F.length(o).cast("string"),
        F.lit(" chars)")))).otherwise(F.array().cast("array<string>"))
    return F.struct((F.size(errors) == 0).alias("is_valid"), errors.alias("errors"),
                    warnings.alias("warnings"))
