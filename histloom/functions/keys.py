"""Deterministic keys and row digests.

* ``prehash_value(a, b, ...)``: every argument cleaned, NULL/blank replaced by
  ``'~'``, joined with ``'|'``.  Never NULL.
* ``hash_uuid(text)``: a 128-bit md5 digest written in the 8-4-4-4-12 UUID
  layout (lower case).  NULL in, NULL out.
* ``hash_key(...)`` / ``row_checksum(...)``: ``hash_uuid(prehash_value(...))``.

Doubles must be cast to DECIMAL before they are hashed: their text form is
engine specific.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, clean_string

# The NULL/blank token and the field separator of prehashed text.
NULL_TOKEN = "~"
SEPARATOR = "|"


def prehash_value(*cols: ColumnLike) -> Column:
    return F.concat_ws(
        SEPARATOR, *[F.coalesce(clean_string(c), F.lit(NULL_TOKEN)) for c in cols]
    )


def hash_uuid(text: ColumnLike) -> Column:
    """md5 hex with '-' inserted after hex digits 8, 12, 16 and 20.  The digest
    is referenced once (nested inserts, right to left), which keeps the
    expression tree -- and Catalyst's work on it -- small."""
    h = F.md5(F.col(text) if isinstance(text, str) else text)
    for pos in (21, 17, 13, 9):
        h = F.overlay(h, F.lit("-"), F.lit(pos), F.lit(0))
    return h


def hash_key(*cols: ColumnLike) -> Column:
    """Natural-key hash over the prehashed parts."""
    return hash_uuid(prehash_value(*cols))


def row_checksum(*cols: ColumnLike) -> Column:
    """Change digest over the tracked attributes (same digest as keys)."""
    return hash_uuid(prehash_value(*cols))


def nullable_hash(c: ColumnLike) -> Column:
    """``DECODE(c, NULL, NULL, hash_key(c))``: hash only present values."""
    cc = F.col(c) if isinstance(c, str) else c
    return F.when(cc.isNull(), F.lit(None).cast("string")).otherwise(hash_key(cc))


def composite_id(*cols: ColumnLike) -> Column:
    """Multi-part business id ``a|b|c`` with blanks as '~' (agreement numbers,
    master contract ids).  Same text as ``prehash_value``."""
    return prehash_value(*cols)
