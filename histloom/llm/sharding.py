"""Jump consistent hashing of stable keys to shards, in Spark expressions only.

The published 64-bit generator (multiplier 2862933555777941757) is stepped with
32-bit limbs, because Spark's long product raises on overflow.  No ring table:
a key and the shard count decide, and one more shard takes rows only into
itself."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import cut_lineage

#: Multiplier of the published generator, in 32-bit halves.
_MULTIPLIER = 2862933555777941757
_M_HI, _M_LO = _MULTIPLIER >> 32, _MULTIPLIER & 0xFFFFFFFF
_LOW32 = 0xFFFFFFFF


def _times_low32(x: Column, m: int) -> tuple[Column, Column]:
    """(low 32 bits, rest) of ``x * m`` for ``0 <= x, m < 2**32`` without overflow."""
    high = F.shiftright(x, 16) * F.lit(m)
    low = x.bitwiseAND(F.lit(0xFFFF)) * F.lit(m)
    t = F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16) + low
    return t.bitwiseAND(F.lit(_LOW32)), F.shiftright(t, 32) + F.shiftright(high, 16)


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """``key * multiplier + 1`` modulo 2**64 on the two halves of ``key``."""
    p, carry = _times_low32(lo, _M_LO)
    plus_one = p + F.lit(1)
    new_lo = plus_one.bitwiseAND(F.lit(_LOW32))
    cross1, _ = _times_low32(lo, _M_HI)
    cross2, _ = _times_low32(hi, _M_LO)
    new_hi = (carry + F.shiftright(plus_one, 32) + cross1 + cross2).bitwiseAND(F.lit(_LOW32))
    return new_hi, new_lo


def jump_hash(key: Column, n_shards: int) -> Column:
    """Shard (0 .. n_shards - 1, int) of a bigint key by jump consistent
    hashing; a null key counts as 0.

    A jump moves at least one bucket on, so ``n_shards`` steps always end;
    about ln(n_shards) are needed.  A short fold does nearly every row, and
    only keys not yet past the end go on with the remaining steps."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_LOW32)).alias("lo"),
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next_state(s["hi"], s["lo"])
        # (key >> 33) + 1 of the 64-bit state is (hi >> 1) + 1
        jump = F.floor((s["j"] + F.lit(1)).cast("double")
                       * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + F.lit(1)).cast("double")))
        return F.when(s["j"] < F.lit(n_shards),
                      F.struct(hi.alias("hi"), lo.alias("lo"), s["j"].alias("b"),
                               jump.cast("long").alias("j"))).otherwise(s)

    first = min(n_shards, 16 + 2 * math.ceil(math.log(n_shards + 1)))
    state = F.aggregate(F.sequence(F.lit(1), F.lit(first)), start, step)
    if first == n_shards:
        return state["b"].cast("int")
    rest = F.sequence(F.lit(1), F.lit(n_shards - first))
    return F.aggregate(
        F.array(state), start,
        lambda _, s: F.when(s["j"] < F.lit(n_shards), F.aggregate(rest, s, step)).otherwise(s),
    )["b"].cast("int")


def assign_slots(rows: DataFrame, group: str, order: list[str], slot: str) -> DataFrame:
    """Adds ``slot``: the gapless rank from 0 of each row within ``group`` by
    ``order``, with no group sorted in one task.

    The rows are dealt by ranges of ``order`` (plus a running number, so that
    equal rows are also spread) and stored; each file is one range.  The rank is
    the count of the group's rows in earlier files plus the rank in the file."""
    ranged = (rows.withColumn("_tie", F.monotonically_increasing_id())
              .repartitionByRange(*[F.col(c).asc_nulls_first() for c in order], F.col("_tie")))
    stored = cut_lineage(ranged)
    file = F.col("_metadata.file_name")        # in the order of ranges by the number in its name
    stored = stored.withColumn("_range", F.concat(
        F.lpad(F.regexp_extract(file, r"part-(\d+)", 1), 10, "0"), F.lit("/"), file))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (stored.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
              .select(F.col(group).alias("_g"), F.col("_range").alias("_r"),
                      F.coalesce(F.sum("_n").over(before.partitionBy(group)), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(group, "_range").orderBy(*[F.col(c).asc_nulls_first() for c in order], "_tie")
    ranked = stored.withColumn("_rank", F.row_number().over(inside) - 1)
    return (ranked.join(starts, ranked[group].eqNullSafe(starts["_g"]) & (ranked["_range"] == starts["_r"]))
            .withColumn(slot, (F.col("_start") + F.col("_rank")).cast("long"))
            .drop("_tie", "_range", "_rank", "_g", "_r", "_start"))


def shard_documents(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """Shards documents by doc_id.  Only doc_id and text are read, so extra
    columns of any name do no harm.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; null text: 1),
    text_crc32 (null text: that of the empty one), law ('key'), shard, slot
    (rank from 0 within the shard by doc_id, text_crc32, size; repeated rows get
    slots of their own in any order), grown_shard (the shard with one more).
    A null doc_id counts as 0.  An empty table gives no rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_hash(F.col("doc_id"), n_shards).alias("shard"),
        jump_hash(F.col("doc_id"), n_shards + 1).alias("grown_shard"))
    # stored first: dealing by ranges reads its input twice, and the texts are read once
    return assign_slots(cut_lineage(rows), "shard", ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
