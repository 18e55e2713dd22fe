"""A Bloom filter of keys, in Spark expressions: rows that cannot have one of the
keys are dropped where they are read, before any exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, hashes per key, and the greatest filter (8 MiB), which bounds what is broadcast.
BITS_PER_KEY, HASHES, MAX_BITS = 10, 4, 1 << 26


def bits_for(n_keys: int) -> int:
    """Bits of a filter for ``n_keys``; 0 if the greatest one would let most rows pass."""
    if 2 * n_keys > MAX_BITS:
        return 0
    return min(MAX_BITS, -(-max(n_keys, 1) * BITS_PER_KEY // 64) * 64)


def _positions(keys: Sequence[str], bits: int) -> list[Column]:
    a, b = (F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(bits)) for seed in (1, 2))
    return [F.pmod(a + F.lit(i) * b, F.lit(bits)) for i in range(HASHES)]


def key_filter(rows: DataFrame, keys: Sequence[str], bits: int) -> Column:
    """The filter of the ``keys`` of ``rows`` as a scalar subquery: ``bits / 64`` longs."""
    at = rows.select(F.explode(F.array(*_positions(keys, bits))).alias("p"))
    words = at.groupBy(F.floor(F.col("p") / 64).alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("w"))
    every = rows.sparkSession.range(bits // 64).join(words, "id", "left").select("id", F.coalesce("w", F.lit(0)).alias("w"))
    return every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "w"))), lambda x: x["w"]).alias("f")).scalar()


def may_have(filter_: Column, keys: Sequence[str], bits: int) -> Column:
    """False for rows whose key is surely not among the filter's."""
    out = F.lit(True)
    for p in _positions(keys, bits):
        out = out & (F.getbit(F.get(filter_, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1)
    return out


def reduce_by_keys(target: DataFrame, rows: DataFrame, keys: Sequence[str], n_keys: int | None = None) -> DataFrame:
    """``target`` without (most of) the rows whose key no row of ``rows`` has; none
    with such a key is lost.  ``n_keys`` is about how many keys ``rows`` has; it is
    counted (roughly) if not given."""
    if n_keys is None:
        n_keys = rows.agg(F.approx_count_distinct(F.struct(*keys)).alias("n")).first()["n"]
    bits = bits_for(n_keys)
    return target.where(may_have(key_filter(rows, keys, bits), keys, bits)) if bits else target
