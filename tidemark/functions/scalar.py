"""Scalar column rules used by the decoders and the result shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import EVENT_TYPES, PRICE_TYPE, UNKNOWN_CATEGORY

# --- Fixed values: textual grammars the original parsers accept.
# Long.parseLong: optional sign, ASCII digits, nothing else (no spaces).
LONG_TEXT = r"^[+-]?[0-9]+$"
# BigDecimal(String): optional sign, digits with optional point, optional exponent.
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# String.isBlank: empty or only Character.isWhitespace code points.
BLANK_TEXT = (r"^[\t\n\x{0B}\f\r\x{1C}-\x{1F}\p{Zs}\p{Zl}\p{Zp}"
              r"&&[^\x{A0}\x{2007}\x{202F}]]*$")
# --- end of fixed values.


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_known_type(col) -> Column:
    """Exact, case-sensitive match on a wire event type."""
    return _c(col).isin(*EVENT_TYPES)


def type_name(col) -> Column:
    """Wire value (``view``) -> constant name used in results (``VIEW``)."""
    return F.upper(_c(col))


def strict_long(col) -> Column:
    """Text -> BIGINT under the Long.parseLong grammar; NULL otherwise (incl. overflow)."""
    c = _c(col)
    return F.when(c.rlike(LONG_TEXT), c.try_cast("bigint"))


def strict_decimal(col) -> Column:
    """Text -> DECIMAL(38,18) under the BigDecimal grammar; NULL otherwise."""
    c = _c(col)
    return F.when(c.rlike(DECIMAL_TEXT), c.try_cast(PRICE_TYPE))


def empty_to_null(col) -> Column:
    """Empty text -> NULL; whitespace is kept (CSV rule)."""
    c = _c(col)
    return F.when(c != F.lit(""), c)


def is_blank(col) -> Column:
    return _c(col).rlike(BLANK_TEXT)


def blank_to_null(col) -> Column:
    """Blank text (empty or whitespace only) -> NULL (web form rule)."""
    c = _c(col)
    return F.when(~is_blank(c), c)


def blank_to_uuid(col) -> Column:
    """Blank text -> a fresh random UUID (36 characters)."""
    c = _c(col)
    return F.when(is_blank(c), F.expr("uuid()")).otherwise(c)


def category_or_unknown(col, fallback: str = UNKNOWN_CATEGORY) -> Column:
    """NULL category -> fallback; an empty string stays its own group."""
    return F.coalesce(_c(col), F.lit(fallback))


def user_key(col="user_id") -> Column:
    """Topic record key: the user id as text."""
    return _c(col).cast("string")
