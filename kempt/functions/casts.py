"""Strict and lenient typed casts for text staged from delimited snapshots.

Float-formatted integers such as ``'299.0'`` become ``299`` (fractions are
truncated).  Plain digits are cast exactly, whatever their length; only
exponent forms go through DOUBLE.  Lenient casts give NULL for anything that is
not a decimal number (type suffixes such as ``12d``, ``NaN``, blanks included)
and for overflow instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A number with digits on at least one side of the point; the groups are its integer part and its exponent.
_PLAIN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"
_EXPONENT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+\s*$"
_WHOLE = r"^\s*([+-]?[0-9]*)"


def _text(c: str | Column) -> Column:
    return _col(c).cast("string")


def _whole(t: Column) -> Column:
    """Integer part of a plain number's text; '.5' has 0."""
    digits = F.regexp_extract(t, _WHOLE, 1)
    return F.when(digits.rlike("[0-9]"), digits).otherwise(F.lit("0"))


def lenient_int(c: str | Column, to: str = "int") -> Column:
    """Text -> integral type; NULL on empty, garbage or overflow."""
    t = _text(c)
    return F.when(t.rlike(_PLAIN), _whole(t).try_cast(to)).when(t.rlike(_EXPONENT), t.try_cast("double").try_cast(to))


def strict_int(c: str | Column, to: str = "int") -> Column:
    """Text -> integral type; raises on bad input or overflow (ANSI cast), NULL stays NULL."""
    t = _text(c)
    return (F.when(t.rlike(_PLAIN), _whole(t).cast(to)).when(t.rlike(_EXPONENT), t.cast("double").cast(to))
            .when(t.isNotNull(), F.raise_error(F.concat(F.lit("not a number: "), t)).cast(to)))


def lenient_decimal(c: str | Column, precision: int = 10, scale: int = 2) -> Column:
    """Text -> DECIMAL(p,s), rounded half up; NULL on empty, garbage or overflow."""
    t = _text(c)
    return F.when(t.rlike(_PLAIN) | t.rlike(_EXPONENT), F.trim(t).try_cast(f"decimal({precision},{scale})"))


def nullable_long(c: str | Column) -> Column:
    """Coerce any numeric-looking text to a nullable BIGINT (export normalisation)."""
    return lenient_int(c, "bigint")


def cast_failed(raw: str | Column, casted: Column) -> Column:
    """True when the text held something (not NULL, not blank) that the cast lost."""
    raw = _col(raw)
    return raw.isNotNull() & (F.trim(raw) != F.lit("")) & casted.isNull()
