"""History-load operators: control columns, change capture, current-row flag.

Skew: one natural key may carry a large share of the rows (blank addresses,
one party with many plans).  Nothing here sorts a whole key group in one
task: "latest row per key" is a ``max(struct(...))`` aggregate (combined
map-side), joined back on the key where every row needs the answer; AQE can
split a hot key of the big side of that join.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.validity import OPEN_END, date_lit, is_open, to_dtm
from ..sources.io import cut_lineage
from .keyfilter import reduce_by_keys

# The control columns every history row carries.
CONTROL_COLUMNS = (
    "begin_dt", "begin_dtm", "row_process_dtm", "audit_id", "logical_delete_ind",
    "check_sum", "current_row_ind", "end_dt", "end_dtm", "source_system_id",
    "restricted_row_ind",
)

# Ranking of versions inside one key: latest end first, then latest begin,
# then the larger checksum; remaining columns break any tie left.
VERSION_ORDER = ("end_dtm", "end_dt", "begin_dtm", "begin_dt", "check_sum")

# "Latest" among stored versions of a key: what was loaded last, then the order
# above.  (An attribute change usually keeps the begin date, so dates alone do
# not say which version is newer.)
LOAD_ORDER = ("audit_id", "row_process_dtm")

# Columns a stored history adds: its partition, and the salt of its buckets.
OPEN_PART, KEY_SALT = "open_ind", "key_salt"

# Columns never used to rank versions.
NOT_RANKED = ("row_process_dtm", "current_row_ind", "change_type",  # as tie-breakers; an order may name them
              OPEN_PART, KEY_SALT)

INSERT, UPDATE, DUPLICATE = "I", "U", "D"


def control_columns(df: DataFrame, source_system_id: str, audit_id: Column,
                    logical_delete: bool = False, restricted: bool = False) -> DataFrame:
    """Stamp lineage and flags: audit id, source system, delete/restricted."""
    return df.select(
        "*",
        audit_id.cast("int").alias("audit_id"),
        F.lit(source_system_id).alias("source_system_id"),
        F.lit(restricted).alias("restricted_row_ind"),
        F.lit(logical_delete).alias("logical_delete_ind"),
    )


def audit_id_for(audit: DataFrame, batch_name: str) -> Column:
    """The audit id of the open batch ``batch_name`` as a scalar subquery.

    Replaces a LEFT JOIN on constants only (which would plan a nested-loop
    join).  More than one matching audit row fails the query instead of
    silently multiplying every source row."""
    return (audit.filter((F.col("record_aligner") == 1) & (F.col("batch_name") == batch_name))
                 .select("audit_id").scalar())


def _rank_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    order = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in order and c not in NOT_RANKED]
    return order + rest


def _key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
              null_safe: bool) -> DataFrame:
    """Join ``right`` (keys renamed to ``_k{i}``) to ``left`` on ``keys``."""
    cond = []
    for i, k in enumerate(keys):
        lc, rc = left[k], right[f"_k{i}"]
        cond.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
    out = left.join(right, cond, how)
    return out.drop(*[f"_k{i}" for i in range(len(keys))])


def _renamed_keys(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]


def open_versions(target: DataFrame, keys: Sequence[str], target_filter: Column | None = None) -> DataFrame:
    """The current, open rows of ``target`` that a batch is compared with.  The filter
    is plain equalities, so it reaches the scan; NULL keys match nothing."""
    cur = target.filter(F.col("current_row_ind") & (F.col("end_dt") == date_lit(OPEN_END)))
    for k in keys:
        cur = cur.filter(F.col(k).isNotNull())
    return cur if target_filter is None else cur.filter(target_filter)


def load_rank(df: DataFrame, checksum: str = "check_sum") -> Column:
    """What makes one stored version of a key the latest; its ``checksum`` comes last."""
    order = [c for c in (*LOAD_ORDER, *VERSION_ORDER) if c in df.columns and c != checksum]
    return F.struct(*order, checksum)


def compare_with_latest(src: DataFrame, latest: DataFrame, keys: Sequence[str],
                        checksum: str = "check_sum") -> DataFrame:
    """Adds ``change_type`` from ``latest``: one row per key (``_k0``, ...) with the
    checksum ``_tgt_sum``.  The join is null-safe over keys that are never NULL: that
    keeps a shuffle between it and an aggregate below, so AQE can split a hot key."""
    j = _key_join(src, latest.withColumn("_tgt_hit", F.lit(True)), keys, "left", null_safe=True)
    change = (F.when(F.col("_tgt_hit").isNull(), F.lit(INSERT))
               .when(F.col("_tgt_sum") != F.col(checksum), F.lit(UPDATE))
               .otherwise(F.lit(DUPLICATE)))
    return j.withColumn("change_type", change).drop("_tgt_sum", "_tgt_hit")


def classify_changes(src: DataFrame, target: DataFrame | None, keys: Sequence[str],
                     target_filter: Column | None = None,
                     checksum: str = "check_sum", reduce: bool = False) -> DataFrame:
    """Add ``change_type``: 'I' key not current in ``target``, 'U' current
    with another checksum, 'D' same checksum (or a NULL checksum).

    Only current, open target rows count.  When a key has several current rows
    the one loaded last is compared (``LOAD_ORDER``, then ``VERSION_ORDER``), so
    the source never fans out.  ``target=None`` means an empty target: every row
    is 'I'.  A NULL key matches nothing.

    With ``reduce`` the target's rows whose key is surely not in ``src`` are dropped
    by a Bloom filter before the aggregate: for a small batch against a long history.
    ``src`` is then read twice."""
    if target is None:
        return src.withColumn("change_type", F.lit(INSERT))
    cur = open_versions(target, keys, target_filter)
    if reduce:
        cur = reduce_by_keys(cur, src, keys)
    latest = (cur.groupBy(*_renamed_keys(keys))
                 .agg(F.max(load_rank(cur, checksum)).getField(checksum).alias("_tgt_sum")))
    return compare_with_latest(src, latest, keys, checksum)


def keep_changes(df: DataFrame) -> DataFrame:
    """Rows to append: inserts and updates."""
    return df.filter(F.col("change_type").isin(INSERT, UPDATE))


def mark_current(df: DataFrame, keys: Sequence[str], order: Sequence[str] = VERSION_ORDER,
                 out: str = "current_row_ind", end_col: str = "end_dt") -> DataFrame:
    """``out`` is true on the latest version of each key when it is open
    (end 9999-12-31).  Equivalent to ``ROW_NUMBER() OVER (PARTITION BY keys
    ORDER BY order..., remaining columns... DESC NULLS LAST) = 1 AND open``.

    NULL keys form one group, as in SQL PARTITION BY.

    9999-12-31 sorts first, so a closed version never is the latest of a key
    that has an open one: only open rows are ranked, and the flag of the others
    is false.  The big side of the join carries its own columns alone; the rank
    is built after it."""
    cols = _rank_columns(df, keys, order)
    best = (df.filter(F.col(end_col) == date_lit(OPEN_END))
            .groupBy(*_renamed_keys(keys)).agg(F.max(F.struct(*cols)).alias("_best")))
    j = _key_join(df, best, keys, "left", null_safe=True)
    flag = F.coalesce(is_open(end_col) & F.struct(*cols).eqNullSafe(F.col("_best")), F.lit(False))
    return j.withColumn(out, flag).drop("_best")


#: At most so many repeated rows are told apart by a small joined table of digests.
FEW = 200_000


def _digest(cols: Sequence[str], seeds: Sequence[int] = (0, 1)) -> list[Column]:
    """128 bits (64 a seed) of the values of ``cols``; NULLs count by their place."""
    return [F.xxhash64(F.lit(seed), *cols, *[F.col(c).isNull() for c in cols]).alias(f"_d{seed}") for seed in seeds]


def keys_occur_once(rows: DataFrame, keys: Sequence[str]) -> bool:
    """Whether no two rows share a key (NULL keys form one group).  64 bits a key move; of
    rows that only share these bits it says that a key occurs twice."""
    n = rows.select(*_digest(keys, (0,))).groupBy("_d0").agg(F.count(F.lit(1)).alias("_n"))
    return not n.agg(F.max("_n") > 1).first()[0]


def distinct_stored(rows: DataFrame) -> DataFrame:
    """``rows.distinct()`` for rows that are stored and mostly differ.

    Digests are counted, 8 bytes a row; only rows whose digest occurs more than once
    are compared whole, the others do not move."""
    digest = _digest(rows.columns, (0,))
    twice = cut_lineage(rows.select(*digest).groupBy("_d0")
                        .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    n = twice.count()
    if not n:
        return rows
    if n > FEW:
        return rows.distinct()
    j = rows.select("*", *digest).join(twice, "_d0", "left")
    again = cut_lineage(j.where("_n IS NOT NULL").select(*rows.columns).distinct())
    return j.where("_n IS NULL").select(*rows.columns).unionByName(again)


def mark_current_stored(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = VERSION_ORDER,
                        out: str = "current_row_ind", end_col: str = "end_dt") -> DataFrame:
    """``mark_current`` for stored rows.

    Per key (128 bits) the open rows are counted and ranked by the columns of fixed width
    that begin the order.  A key's only open row is current.  Where some keys have more,
    the rows are joined once with these keys' first rank and stored; rows that share it
    go through ``mark_current``."""
    types, first = dict(rows.dtypes), []
    for c in order:
        if c in types:
            if types[c] in ("string", "binary") or "<" in types[c]:
                break
            first.append(c)
    if not first:
        return mark_current(rows, keys, order, out, end_col)
    is_open_row = is_open(end_col)
    ranked = (rows.where(F.col(end_col) == date_lit(OPEN_END)).select(*_digest(keys), F.struct(*first).alias("_rank"))
              .groupBy("_d0", "_d1").agg(F.max("_rank").alias("_first"), F.count(F.lit(1)).alias("_n")))
    shared = cut_lineage(ranked.where("_n > 1").select("_d0", "_d1", "_first"))
    if shared.isEmpty():
        return rows.withColumn(out, is_open_row)
    alone = F.col("_first").isNull()
    j = rows.select("*", *_digest(keys)).join(shared, ["_d0", "_d1"], "left")
    j = cut_lineage(j.select(*rows.columns, (is_open_row & alone).alias("_only"),
                             (is_open_row & ~alone & F.struct(*first).eqNullSafe(F.col("_first"))).alias("_tied")))
    tied = mark_current(j.where("_tied").select(*rows.columns), keys, order, out, end_col)
    plain = [c for c in rows.columns if c != out]
    settled = j.where("NOT _tied").select(*plain, F.col("_only").alias(out))
    return settled.unionByName(tied.select(*plain, out)).select(*tied.columns)


#: From so many columns on, rows are much wider than a key and a checksum.
WIDE = 32


def classify_stored(rows: DataFrame, target: DataFrame, keys: Sequence[str], target_filter: Column | None = None,
                    checksum: str = "check_sum") -> tuple[DataFrame, bool]:
    """``classify_changes`` for wide rows that are stored; also whether a join takes part.

    Keys (128 bits) and checksums are compared first.  If all rows come out alike, they
    do not move; if all but ``FEW`` do, the others are told by a small joined table."""
    cur = open_versions(target, keys, target_filter)
    latest = cut_lineage(cur.select(*_digest(keys), load_rank(cur, checksum).alias("_rank")).groupBy("_d0", "_d1")
                         .agg(F.max("_rank").getField(checksum).alias("_tgt_sum"))
                         .select(*_renamed_keys(("_d0", "_d1")), "_tgt_sum"))
    pair = [F.col("_d0"), F.col("_d1"), *[c.alias("_sum") for c in _digest([checksum], (0,))]]
    kinds = cut_lineage(compare_with_latest(rows.select(*_digest(keys), checksum), latest, ("_d0", "_d1"), checksum)
                        .select(*pair, "change_type"))
    found = {r.change_type: r["count"] for r in kinds.groupBy("change_type").count().collect()}
    most = max(found, key=found.get, default=INSERT)
    few = sum(found.values()) - found.get(most, 0)
    if not few:
        return rows.withColumn("change_type", F.lit(most)), False
    keyed = rows.select("*", *_digest(keys))
    if few > FEW:
        return compare_with_latest(keyed, latest, ("_d0", "_d1"), checksum).drop("_d0", "_d1"), True
    others = kinds.where(F.col("change_type") != most).distinct()
    j = keyed.select("*", *pair[2:]).join(others, ["_d0", "_d1", "_sum"], "left")
    return j.select(*rows.columns, F.coalesce("change_type", F.lit(most)).alias("change_type")), True


def reflag_current(df: DataFrame, keys: Sequence[str], out: str = "current_row_ind") -> DataFrame:
    """The flag over stored and new versions together: of each key only the
    version loaded last stays current, if it is open."""
    return mark_current(df.drop(out), keys, (*LOAD_ORDER, *VERSION_ORDER), out).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Top-1 row per key by ``order`` (all DESC NULLS LAST, remaining columns
    break ties).  One partial+final aggregate, no window over the group."""
    cols = _rank_columns(df, keys, order)
    best = df.groupBy(*keys).agg(F.max(F.struct(*cols)).alias("_best"))
    return best.select(*keys, *[F.col("_best").getField(c).alias(c) for c in cols]) \
               .select(*df.columns)


def restart_begin_on_update(df: DataFrame, as_of: str | _dt.date) -> DataFrame:
    """An update version starts at ``as_of`` instead of the source begin."""
    upd = F.col("change_type") == F.lit(UPDATE)
    d = date_lit(as_of)
    return (df.withColumn("begin_dt", F.when(upd, d).otherwise(F.col("begin_dt")))
              .withColumn("begin_dtm", F.when(upd, to_dtm(d)).otherwise(F.col("begin_dtm"))))


#: What a comparison target keeps beside the keys: enough to rank versions.
TARGET_VIEW = ("end_dt", "end_dtm", "begin_dt", "begin_dtm", "current_row_ind", "check_sum",
               "source_system_id", "audit_id", "row_process_dtm")


def effective_target(dimension: DataFrame | None, work: DataFrame | None,
                     keys: Sequence[str], checksum: str = "check_sum", distinct: bool = True) -> DataFrame | None:
    """Comparison target for a load that also checks the conformed dimension:
    dimension rows not superseded by a current open work row of the same key
    with another checksum, UNION (distinct) the work rows.  A comparison takes the
    latest row of each key, so it needs no ``distinct``."""
    given = dimension if dimension is not None else work
    if given is None:
        return None
    cols = [*keys, *[c for c in TARGET_VIEW if c in given.columns]]
    unique = DataFrame.distinct if distinct else lambda df: df
    if dimension is None:
        return unique(work.select(*cols))
    dim = dimension.select(*cols)
    if work is None:
        return unique(dim)
    cur = (work.filter(F.col("current_row_ind") & (F.col("end_dt") == date_lit(OPEN_END)))
               .select(*_renamed_keys(keys), F.col(checksum).alias("_wrk_sum")))
    cond = [dim[k] == cur[f"_k{i}"] for i, k in enumerate(keys)]
    cond.append(dim[checksum] != cur["_wrk_sum"])
    kept = dim.join(cur, cond, "left_anti")
    return unique(kept.unionByName(work.select(*cols)))


def union_distinct(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def fan_out(df: DataFrame, variants: Sequence[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """For each row and each variant (condition, named values) whose condition
    holds, the row with the variant's values added: one scan and one join serve
    several kinds of result rows.  All variants name the same values."""
    options = F.array(*[F.struct(F.coalesce(keep, F.lit(False)).alias("_keep"),
                                 *[v.alias(k) for k, v in values.items()]) for keep, values in variants])
    return (df.select("*", F.explode(F.filter(options, lambda o: o["_keep"])).alias("_v"))
            .select(*df.columns, *[F.col("_v").getField(k).alias(k) for k in variants[0][1]]))
