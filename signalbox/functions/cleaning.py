"""Scalar cleaning rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^[+-]?\d+(\.0*)?$"
_EDGE_SPACE = r"^\s+|\s+$"


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def strip_all(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind (tabs, newlines)."""
    return F.regexp_replace(_text(c), _EDGE_SPACE, "")


def integers_or_null(c: Column | str) -> Column:
    """Integer text ('12', '-5', '5.0') -> int; anything else -> null."""
    t = strip_all(c)
    return F.when(t.rlike(_INTEGER), t.try_cast("double").try_cast("int"))


def three_char_code(c: Column | str) -> Column:
    """White space stripped, upper case, kept only when 3 characters long."""
    t = strip_all(c)
    return F.when(F.length(t) == 3, F.upper(t))


def upper_code(c: Column | str) -> Column:
    return F.upper(strip_all(c))


def boolean_or_null(c: Column | str) -> Column:
    """I04: 'true' / 'false' (any case, padded) -> boolean, else null."""
    return F.lower(strip_all(c)).try_cast("boolean")


def int_or_null(c: Column | str) -> Column:
    """Integer text -> int, else null."""
    return strip_all(c).try_cast("int")


def split_routes(c: Column | str) -> Column:
    """Remove paragraph tags, split on ' / '."""
    cleaned = F.regexp_replace(_text(c), r"</?p>", "")
    return F.when(cleaned.isNotNull(), F.split(cleaned, " / "))


def percent_or_null(c: Column | str) -> Column:
    """I07: '80%' -> 80.0; text that is not a number -> null."""
    t = F.regexp_replace(strip_all(c), r"^%+|%+$", "")
    return t.try_cast("double")
