"""A history kept in the catalog.

Open and closed versions are partitions of their own, so a load that compares with
open versions never lists the closed ones.  With ``buckets`` the files are bucketed
and sorted on the natural key and a salt, so a batch is compared without moving
the history: the batch's distinct keys go to the buckets, and what they hit is
aggregated there.  The salt deals a key's versions over ``salts`` buckets, so that
a key with a large share of the rows does not fill one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.validity import is_open
from ..operators.history import KEY_SALT as SALT
from ..operators.history import OPEN_PART as OPEN
from ..operators.history import NOT_RANKED, compare_with_latest, load_rank, open_versions, reflag_current
from ..plans.targets import struct_type
from .tables import append_by_name, overwrite_partitions, scratch_table


class HistoryTable:
    """A stored history of ``layout`` (with the control columns) and natural ``keys``."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], salts: int = 1, buckets: int = 0):
        self.spark, self.name, self.keys, self.salts, self.buckets = spark, name, tuple(keys), salts, buckets

    @classmethod
    def create(cls, spark: SparkSession, kind: str, layout: list, keys: Sequence[str], buckets: int = 0,
               salts: int = 8) -> "HistoryTable":
        """An empty scratch table; ``buckets=0`` only partitions it."""
        schema = struct_type([*layout, (SALT, "int"), (OPEN, "boolean")])
        by = [*keys, SALT] if buckets else []
        return cls(spark, scratch_table(spark, kind, schema, [OPEN], by, buckets), keys, salts, buckets)

    def append(self, rows: DataFrame) -> None:
        """Append versions by column name; each bucket of a batch is written once."""
        rest = [c for c in rows.columns if c not in (*self.keys, *NOT_RANKED)]
        salt = F.pmod(F.xxhash64(*rest), F.lit(self.salts)).cast("int")
        rows = rows.withColumn(SALT, salt).withColumn(OPEN, F.coalesce(is_open("end_dt"), F.lit(False)))
        if self.buckets:
            rows = rows.repartition(self.buckets, *self.keys, SALT)
        append_by_name(rows, self.name)

    def read(self) -> DataFrame:
        """All versions, with the layout's columns."""
        return self.spark.table(self.name).drop(OPEN, SALT)

    def open_versions(self, target_filter: Column | None = None) -> DataFrame:
        """Current open versions; only the partition of open ones is listed and read."""
        return open_versions(self.spark.table(self.name).where(F.col(OPEN)), self.keys, target_filter)

    def classify(self, src: DataFrame, target_filter: Column | None = None, checksum: str = "check_sum") -> DataFrame:
        """``classify_changes`` against the stored history.

        The distinct keys of ``src`` (a hot one is a single row) are dealt to the
        buckets; the versions they hit are aggregated per key and salt in place and
        then, a few rows per key of the batch, per key.  ``src`` is read twice."""
        wanted = src.select(*self.keys)
        for k in self.keys:
            wanted = wanted.where(F.col(k).isNotNull())
        wanted = wanted.distinct().withColumn(SALT, F.explode(F.array(*[F.lit(i) for i in range(self.salts)])))
        hit = self.open_versions(target_filter).join(wanted, [*self.keys, SALT], "left_semi")
        rank = load_rank(hit, checksum)
        per_salt = hit.groupBy(*self.keys, SALT).agg(F.max(rank).alias("_rank"))
        latest = per_salt.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]).agg(
            F.max("_rank").getField(checksum).alias("_tgt_sum"))
        return compare_with_latest(src, latest, self.keys, checksum)

    def reflag(self) -> None:
        """Settle the current-row flag over all stored versions.  A closed version never
        is current, so only the partition of open ones is read and rewritten."""
        table = self.spark.table(self.name)
        rows = reflag_current(table.where(F.col(OPEN)).drop(OPEN), self.keys).withColumn(OPEN, F.lit(True))
        if self.buckets:
            rows = rows.repartition(self.buckets, *self.keys, SALT)
        overwrite_partitions(rows, self.name)
