"""The PII pattern catalogue.

Every pattern is scanned on its own (matches of different patterns may
overlap) and the catalogue order is significant: it is the tie-break when two
candidates start at the same offset. Each entry carries

* ``source``  - the pattern as published, Python ``re`` dialect, always
  applied case-insensitively;
* ``java``    - the form Spark runs (``java.util.regex``). It must return the
  same match list as ``source`` under Python semantics. Two entries are
  rewritten so the JVM neither overflows its stack nor goes quadratic on
  long texts (see the notes on ``NAME`` and the comma address form);
* ``group``   - which capture group is the entity span. It is always a suffix
  of the whole match, so its start is ``match end - length(group)``.

``(?iU)`` makes the JVM patterns case-insensitive and Unicode-aware
(``\\b``, ``\\d``, ``\\s`` and case folding behave like Python ``str``
patterns, independent of the JDK version).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------
# The default confidence of a regex entity, the least length of a stripped
# entity, the known false positives (compared case-insensitively with the whole
# entity text) and, below, CATALOGUE: entity types and their regexes, in order.
DEFAULT_CONFIDENCE = 0.8
MIN_ENTITY_CHARS = 2

FALSE_POSITIVES: dict[str, tuple[str, ...]] = {
    "EMAIL": ("@gmail", "@yahoo", "@hotmail"),
    "NAME": ("Test", "test", "My Name", "Last Name"),
    "ADDRESS": ("New York", "Test Lane"),
}


# Capitalised word run after a lead-in. Nothing follows the group, so the
# greedy path is the only one that can succeed; possessive quantifiers take it
# without the per-repetition recursion that overflows the JVM stack on
# "i am" followed by thousands of words.
_NAME_RUN_JAVA = r"([A-Z][a-z]+(?:\s+[A-Z][a-z]++)*+)"

# "words, words[, 12345]". The published form retries every start inside a
# long letter/space run without a comma, which is quadratic. A match can only
# begin at the first word boundary of a run (or where the previous match
# ended, \G), so the Java form anchors there and skips the run prefix
# atomically; group 1 is the published match.
_CITY_JAVA = (
    r"(?:(?<![A-Za-z\s])|\G)(?>[A-Za-z\s]*?\b)"
    r"([A-Za-z\s]++,\s+[A-Za-z\s]+(?:,\s+\d{5})?\b)"
)

# The lead-ins of the NAME patterns, in lower case, and the letters that are none of
# ASCII but equal one of it when case is ignored (``i`` and ``s`` are in the lead-ins).
_NAME_LEADS = (("my name is", "i am", "i'm"), ("first and last name",))
FOLDED_LETTERS = ("\u0130", "\u0131", "\u017f")

# Asked before the word boundary, which costs more: most characters are no digits.
_DIGIT_NEXT = r"(?=\d)"

JAVA_FLAGS = "(?iU)"


@dataclass(frozen=True)
class PiiPattern:
    ordinal: int
    entity_type: str
    source: str
    java: str
    group: int = 0
    # Cheap row test that is necessary for a match; lets the regex be skipped: a text to
    # contain, "digit", or texts in lower case of which one is to be in it, whatever its case.
    guard: str | tuple[str, ...] | None = None
    # Whether a match can have fewer than 2 non-space characters (then the
    # stripped-length check must run). Only the comma address form can; every
    # other catalogue pattern needs at least 2 digits/letters by construction.
    may_be_short: bool = True

    @property
    def java_regex(self) -> str:
        return JAVA_FLAGS + self.java

    @property
    def plain(self) -> str:
        """The published form without Python-only escapes (for RE2 cross-checks)."""
        return self.source.replace("\\'", "'")

    @property
    def plain_group(self) -> int:
        """Span group of the published form (only the NAME patterns use group 1)."""
        return 1 if self.entity_type == "NAME" else 0


def _p(ordinal, entity_type, source, java=None, group=0, guard=None, may_be_short=False):
    return PiiPattern(ordinal, entity_type, source, java if java is not None else source,
                      group, guard, may_be_short)


CATALOGUE: tuple[PiiPattern, ...] = (
    _p(0, "EMAIL", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", guard="@"),
    _p(1, "EMAIL", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\b", guard="@"),
    _p(2, "PHONE", r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b", java=_DIGIT_NEXT + r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b", guard="digit"),
    _p(3, "PHONE", r"\(\d{3}\)\s*\d{3}[-.]?\d{4}\b", guard="("),
    _p(4, "PHONE", r"\b\d{3}\s+\d{3}\s+\d{4}\b", java=_DIGIT_NEXT + r"\b\d{3}\s+\d{3}\s+\d{4}\b", guard="digit"),
    _p(5, "SSN", r"\b\d{3}[-]?\d{2}[-]?\d{4}\b", java=_DIGIT_NEXT + r"\b\d{3}[-]?\d{2}[-]?\d{4}\b", guard="digit"),
    _p(6, "ZIP_CODE", r"\b\d{5}(?:-\d{4})?\b", java=_DIGIT_NEXT + r"\b\d{5}(?:-\d{4})?\b", guard="digit"),
    _p(7, "ADDRESS", r"\b\d+\s+[A-Za-z\s]+(Street|St|Lane|Ln|Avenue|Ave|Road|Rd|Drive|Dr|Boulevard|Blvd|Circle|Cir|Court|Ct)\b", guard="digit"),
    _p(8, "ADDRESS", r"\b[A-Za-z\s]+,\s+[A-Za-z\s]+(?:,\s+\d{5})?\b", java=_CITY_JAVA,
       group=1, guard=",", may_be_short=True),
    _p(9, "CREDIT_CARD", r"\b(?:\d{4}[-\s]?){3}\d{4}\b", java=_DIGIT_NEXT + r"\b(?:\d{4}[-\s]?){3}\d{4}\b", guard="digit"),
    _p(10, "NAME", r"(?:my name is|I am|I\'m)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)",
       java=r"(?:my name is|I am|I'm)\s+" + _NAME_RUN_JAVA, group=1, guard=_NAME_LEADS[0]),
    _p(11, "NAME", r"(?:first and last name[,\s]+)([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)",
       java=r"(?:first and last name[,\s]+)" + _NAME_RUN_JAVA, group=1, guard=_NAME_LEADS[1]),
)

ENTITY_TYPES: tuple[str, ...] = tuple(dict.fromkeys(p.entity_type for p in CATALOGUE))


def patterns_for_type(entity_type: str) -> list[PiiPattern]:
    """Patterns of one type in catalogue order; unknown type -> []."""
    return [p for p in CATALOGUE if p.entity_type == entity_type]


def all_pattern_types() -> list[str]:
    return list(ENTITY_TYPES)


def _checked_group(regex: str, group: int) -> int:
    """The span group, if what follows it in the pattern has no width.

    Offsets are counted from the end of the match, so a span group must be its
    last part; ``$``, ``\\b`` and lookaheads may follow.
    """
    if not group:
        return 0
    close, depth, seen, i = -1, [], 0, 0
    while i < len(regex):
        c = regex[i]
        if c == "\\":
            if regex[i + 1:i + 2] == "Q":
                i = regex.find("\\E", i)
                i = len(regex) if i < 0 else i
            i += 2
            continue
        if c == "[":
            i += 2 if regex[i + 1:i + 2] != "^" else 3  # a first ] is literal
            while i < len(regex) and regex[i] != "]":
                i += 2 if regex[i] == "\\" else 1
        elif c == "(":
            capture = regex[i + 1:i + 2] != "?" or (regex[i + 1:i + 3] == "?<" and regex[i + 3:i + 4] not in "=!")
            seen += capture
            depth.append(seen if capture else 0)
        elif c == ")" and depth and depth.pop() == group:
            close = i
        i += 1
    if close < 0:
        raise ValueError(f"pattern has no group {group}: {regex}")
    if not re.fullmatch(r"(?:\$|\\[bBzZ]|\(\?=.*\)|\(\?!.*\)|\))*", regex[close + 1:], re.S):
        raise ValueError(f"group {group} must end the pattern (put what follows into a lookahead): {regex}")
    return group


def select_patterns(types=None, patterns=None) -> tuple[PiiPattern, ...]:
    """Resolve the ``types``/``patterns`` arguments of the detectors.

    ``patterns`` replaces the catalogue (a sequence of PiiPattern, or of
    ``(entity_type, java_regex[, group])`` tuples); ``types`` keeps only the
    listed entity types, catalogue order preserved.
    """
    if patterns is None:
        chosen = CATALOGUE
    else:
        chosen = []
        for i, p in enumerate(patterns):
            if isinstance(p, PiiPattern):
                chosen.append(p)
            else:
                et, rx, *rest = p
                chosen.append(PiiPattern(i, et, rx, rx, _checked_group(rx, rest[0] if rest else 0)))
        chosen = tuple(chosen)
    if types is not None:
        wanted = set(types)
        chosen = tuple(p for p in chosen if p.entity_type in wanted)
    return chosen
