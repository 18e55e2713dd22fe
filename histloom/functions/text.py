"""String normalisation used by every load.

All helpers return native Column expressions, so Catalyst can fold constants
(``clean_string(lit(''))`` becomes a typed NULL) and whole-stage codegen keeps
them in the JVM.  A column argument may be a Column or a column name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col_(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: ColumnLike) -> Column:
    """Render any scalar as text (ints '12', decimals '12.50', dates
    'yyyy-MM-dd', booleans 'true')."""
    return col_(c).cast("string")


def clean_string(c: ColumnLike) -> Column:
    """Trim surrounding blanks; an empty result becomes NULL.  Case is kept."""
    return F.nullif(F.trim(as_text(c)), F.lit(""))


def blank() -> Column:
    """The value of cleaning an empty literal: a NULL string."""
    return F.lit(None).cast("string")


def normalise(c: ColumnLike) -> Column:
    """``upper(trim(c))``: the form codes and flags are compared in."""
    return F.upper(F.trim(as_text(c)))


def is_flag(c: ColumnLike, value: str = "Y") -> Column:
    """Active-record style test ``upper(trim(c)) = value`` (NULL is false)."""
    return F.coalesce(normalise(c) == F.lit(value), F.lit(False))


def int_text(c: ColumnLike) -> Column:
    """``TO_CHAR(c::INTEGER)``; the input must be integral."""
    return col_(c).cast("int").cast("string")


def join_text(*parts: ColumnLike, sep: str = "_") -> Column:
    """NULL-propagating concatenation ``a || sep || b ...`` of text parts."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(as_text(p))
    return F.concat(*pieces)


# Line breaks and tabs that the step runner turns into blanks.
WHITESPACE_PATTERN = "(?>\r\n|\n|\r|\t)"


def flatten_whitespace(c: ColumnLike) -> Column:
    """Trim, then turn each CRLF, LF, CR or TAB into one blank."""
    return F.regexp_replace(F.trim(as_text(c)), WHITESPACE_PATTERN, " ")
