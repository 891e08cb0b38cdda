"""Predicate builders: each returns a ``Column`` usable in ``filter`` or ``when``.

Semantics (one place, applied by every builder):

* string comparisons are case-insensitive;
* positive predicates are plain three-valued expressions, so a missing value
  never matches and flat comparisons on stored columns still reach the parquet
  scan as pushed filters;
* negative predicates are the exact complement of the positive one: a missing
  value *is* kept.  ``negate`` coalesces to false before ``NOT``, which is what
  makes ``p`` and ``negate(p)`` partition the input;
* predicates on a list field (``details.value``, ``categoryPath.name``) mean
  "some element matches"; their negation means "no element matches".
  ``exists`` over a list holding a null element is NULL rather than false, so
  every element test is coalesced first.

Everything is a built-in expression (higher-order ``exists`` for the lists):
no UDF, no Python per row.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(field: str) -> Column:
    return F.col(field)


#: Prefix of a stored case-folded copy of a text field (see ``store_catalogue``).
FOLDED = "folded_"


def folded_fields(columns: Iterable[str]) -> frozenset[str]:
    """The text fields of which a catalogue stores a case-folded copy."""
    return frozenset(c.removeprefix(FOLDED) for c in columns if c.startswith(FOLDED))


def _text(field: str, folded: frozenset[str]) -> Column:
    """The field in lower case: its stored copy, which a scan can filter, or computed."""
    return _c(FOLDED + field) if field in folded else F.lower(_c(field))


def _is_text(value) -> bool:
    return isinstance(value, str)


def negate(pred: Column) -> Column:
    """Exact complement: rows where ``pred`` is false *or* unknown."""
    return ~F.coalesce(pred, F.lit(False))


# -- flat fields -------------------------------------------------------------

def eq(field: str, value, folded: frozenset[str] = frozenset()) -> Column:
    """``field=value``; text compares case-insensitively, booleans and numbers exactly."""
    if _is_text(value):
        return _text(field, folded) == F.lit(value.lower())
    return _c(field) == F.lit(value)


def ne(field: str, value, folded: frozenset[str] = frozenset()) -> Column:
    """``field!=value`` (also spelled ``<>``); a missing value is kept."""
    if _is_text(value):
        return negate(eq(field, value, folded))
    return ~_c(field).eqNullSafe(F.lit(value))


def lt(field: str, value) -> Column:
    return _c(field) < F.lit(value)


def gt(field: str, value) -> Column:
    return _c(field) > F.lit(value)


def gt_ts(field: str, cutoff: Column) -> Column:
    """Strictly after a cutoff timestamp (``TIMESTAMP_NTZ`` column or literal)."""
    return _c(field) > cutoff


def prefix(field: str, text: str, folded: frozenset[str] = frozenset()) -> Column:
    """``field=text*``: case-insensitive prefix.  ``startswith`` rather than
    ``LIKE``, because values may hold ``%`` or ``_``."""
    return F.startswith(_text(field, folded), F.lit(text.lower()))


def isin(field: str, values: Iterable, folded: frozenset[str] = frozenset()) -> Column:
    values = list(values)
    if values and all(_is_text(v) for v in values):
        return _text(field, folded).isin([v.lower() for v in values])
    return _c(field).isin(values)


def all_of(*preds: Column) -> Column:
    """Conjunction ``a&b&...``."""
    return functools.reduce(operator.and_, preds)


def any_of(*preds: Column) -> Column:
    """Disjunction ``(a|b|...)``."""
    return functools.reduce(operator.or_, preds)


# -- list fields (``list.field``) ---------------------------------------------

def _split(path: str) -> tuple[str, str]:
    arr, _, member = path.partition(".")
    if not member:
        raise ValueError(f"expected 'list.field', got {path!r}")
    return arr, member


def _element_eq(member: str, value: str):
    v = value.lower()
    return lambda e: F.coalesce(F.lower(e[member]) == F.lit(v), F.lit(False))


def _element_prefix(member: str, text: str):
    t = text.lower()
    return lambda e: F.coalesce(F.startswith(F.lower(e[member]), F.lit(t)), F.lit(False))


def any_eq(path: str, value: str) -> Column:
    """``details.value=nvidia``: some element equals ``value``."""
    arr, member = _split(path)
    return F.coalesce(F.exists(F.col(arr), _element_eq(member, value)), F.lit(False))


def any_prefix(path: str, text: str) -> Column:
    """``categoryPath.name=laptop*``: some element starts with ``text``."""
    arr, member = _split(path)
    return F.coalesce(F.exists(F.col(arr), _element_prefix(member, text)), F.lit(False))


def none_eq(path: str, value: str) -> Column:
    """``details.value!=intel``: no element equals ``value``."""
    return ~any_eq(path, value)


def none_prefix(path: str, text: str) -> Column:
    """``details.value!=1650*``: no element starts with ``text``."""
    return ~any_prefix(path, text)


# -- search ------------------------------------------------------------------

def search(keyword: str, field: str = "name") -> Column:
    """``(search=kw)``: ``kw`` occurs as a whole word of ``field``."""
    words = F.split(F.lower(_c(field)), r"\W+")
    return F.array_contains(words, F.lit(keyword.lower()))


def anti_prefix_local(field: str, text: str) -> Column:
    """The archived local post-filter: drop values starting with ``text``,
    **case-sensitively**, keeping missing values."""
    return ~F.coalesce(F.startswith(_c(field), F.lit(text)), F.lit(False))
