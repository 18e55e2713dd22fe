"""Lower-cased ASCII-alphanumeric and non-ASCII terms, on UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A-Z become a-z; every other ASCII character that is no letter or digit becomes a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The maximal runs of letters, digits and non-ASCII characters, only A-Z
    lower-cased; none of a null text."""
    return text.translate(_FOLD).split() if text else []


def sum_by_key(df: DataFrame, column: str, size: int, keys_of) -> np.ndarray:
    """Of the batches' ``column``, ``keys_of(list)`` gives arrays of keys below
    ``size``; how often each occurs in all rows.  A task returns one row per key
    it saw, so what is exchanged and collected is bounded by ``size``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            n += np.bincount(keys_of(batch.column(0).to_pylist()), minlength=size)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["k", "n"])
    out = np.zeros(size, np.int64)
    for r in df.select(column).mapInArrow(run, "k long, n long").groupBy("k").agg({"n": "sum"}).collect():
        out[r[0]] = r[1]
    return out
