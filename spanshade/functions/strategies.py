"""Redaction strategies as Column functions ``(text, entity_type) -> replacement``.

All are native expressions. ``register_strategy`` adds user strategies with
the same signature (a user may wrap Python logic in a ``pandas_udf`` there;
the built-ins never leave the JVM).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, digits, let, ustrip

StrategyFn = Callable[[Column, Column], Column]

# --- Fixed values: the placeholder per entity type ---------------------------
# Also fixed: in partial masks EMAIL keeps the first user character and the
# domain, PHONE becomes ***-***-<last 4 digits>, CREDIT_CARD
# ****-****-****-<last 4 digits>; a hash is [<TYPE>_<first 8 hex digits of the
# MD5 of the UTF-8 text>].
PLACEHOLDERS: dict[str, str] = {
    "EMAIL": "[REDACTED_EMAIL]",
    "PHONE": "[REDACTED_PHONE]",
    "PERSON": "[REDACTED_PERSON]",
    "SSN": "[REDACTED_SSN]",
    "ADDRESS": "[REDACTED_ADDRESS]",
    "ZIP_CODE": "[REDACTED_ZIP]",
    "CREDIT_CARD": "[REDACTED_CREDIT_CARD]",
    "CUSTOMER_ACCOUNT": "[REDACTED_ACCOUNT]",
    "NAME": "[REDACTED_NAME]",
    "OTHER": "[REDACTED]",
}
DEFAULT_PLACEHOLDER = "[REDACTED]"


def _stars(n: Column) -> Column:
    return F.repeat(F.lit("*"), F.greatest(n, F.lit(0)))


def placeholder(text: Column, entity_type: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for kv in PLACEHOLDERS.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, entity_type), F.lit(DEFAULT_PLACEHOLDER))


def mask(text: Column, entity_type: Column) -> Column:
    # stripped once, like the digits below: every mention of a Column in a lambda is evaluated anew
    return let(ustrip(text), lambda s: let(F.length(s), lambda n: (
        F.when(n <= 2, _stars(n))
        .when(n <= 4, F.concat(F.substring(s, 1, 1), _stars(n - 2), F.substring(s, -1, 1)))
        .otherwise(F.concat(F.substring(s, 1, 2), _stars(n - 3), F.substring(s, -1, 1))))))


def remove(text: Column, entity_type: Column) -> Column:
    return F.lit("")


def hash_label(text: Column, entity_type: Column) -> Column:
    return F.concat(F.lit("["), entity_type, F.lit("_"), F.substring(F.md5(text), 1, 8),
                    F.lit("]"))


def _default_partial(s: Column) -> Column:
    n = F.length(s)
    return F.when(n <= 2, _stars(n)).otherwise(
        F.concat(F.substring(s, 1, 1), _stars(n - 2), F.substring(s, -1, 1)))


def _last_digits(s: Column, shown: str) -> Column:
    return let(digits(s), lambda d: F.when(F.length(d) >= 4, F.concat(F.lit(shown), F.substring(d, -4, 4)))
               .otherwise(_default_partial(s)))


def _partial(s: Column, entity_type: Column) -> Column:
    user = F.substring_index(s, "@", 1)
    domain = F.substring(s, F.length(user) + 2, F.length(s))
    masked_user = F.when(F.length(user) == 0, F.lit("*")).otherwise(
        F.concat(F.substring(user, 1, 1), _stars(F.length(user) - 1)))
    email = F.when(s.contains("@"), F.concat(masked_user, F.lit("@"), domain)) \
        .otherwise(_default_partial(s))
    return (
        F.when(entity_type == "EMAIL", email)
        .when(entity_type == "PHONE", _last_digits(s, "***-***-"))
        .when(entity_type == "CREDIT_CARD", _last_digits(s, "****-****-****-"))
        .otherwise(_default_partial(s))
    )


def partial(text: Column, entity_type: Column) -> Column:
    return let(ustrip(text), lambda s: _partial(s, entity_type))


_REGISTRY: dict[str, StrategyFn] = {
    "placeholder": placeholder,
    "mask": mask,
    "remove": remove,
    "hash": hash_label,
    "partial": partial,
}


def available_strategies() -> list[str]:
    return list(_REGISTRY)


def get_strategy(name: str) -> StrategyFn:
    """Strategy by name; unknown names fail before any job is launched."""
    if name not in _REGISTRY:
        raise ValueError(f"Unknown strategy '{name}'. Available: {available_strategies()}")
    return _REGISTRY[name]


def register_strategy(name: str, fn: StrategyFn) -> None:
    """Add a strategy ``fn(text: Column, entity_type: Column) -> Column``."""
    _REGISTRY[name] = fn


def replacement(text, entity_type, strategy: str | StrategyFn = "placeholder") -> Column:
    fn = get_strategy(strategy) if isinstance(strategy, str) else strategy
    return fn(col_of(text), col_of(entity_type))


def strategy_info(name: str) -> dict:
    """Redaction configuration echo."""
    fn = get_strategy(name)
    return {"current_strategy": name, "available_strategies": available_strategies(),
            "strategy_function": getattr(fn, "__name__", "custom")}
