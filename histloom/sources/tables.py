"""Catalog tables: creation, column lists, appends by name, statistics and
rewriting single partitions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .io import SHUFFLE_CLEANUP, cut_lineage, scratch_path, setting

#: Column metadata that marks a column whose values the table's owner gives.
IDENTITY = "identity"

_scratch: list[str] = []


def scratch_table(spark: SparkSession, kind: str, schema: StructType, partition_by: Sequence[str] = (),
                  bucket_by: Sequence[str] = (), buckets: int = 0) -> str:
    """Create an empty parquet table of a name of its own, stored under the shared
    checkpoint folder; returns the name.  ``drop_scratch_tables`` removes it."""
    name = f"hl_{kind}_{uuid.uuid4().hex[:12]}"
    create_table(spark, name, schema, scratch_path(spark, f"table-{name}"), partition_by, bucket_by, buckets)
    _scratch.append(name)
    return name


def create_table(spark: SparkSession, name: str, schema: StructType, path: str | None = None,
                 partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int = 0) -> None:
    """Create a parquet table; identity columns are marked in the column's comment."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{IDENTITY}'" if f.metadata.get(IDENTITY) else "")
                        for f in schema)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    cluster = (f" CLUSTERED BY ({', '.join(bucket_by)}) SORTED BY ({', '.join(bucket_by)}) INTO {buckets} BUCKETS"
               if buckets else "")
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parts}{cluster}{where}")


def drop_scratch_tables(spark: SparkSession) -> int:
    """Drop this process's scratch tables and delete their files; returns how many."""
    jvm, n = spark.sparkContext._jvm, 0
    while _scratch:
        name = _scratch.pop()
        where = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, f"table-{name}"))
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        n += 1
    return n


def identity(field: StructField) -> StructField:
    return StructField(field.name, field.dataType, field.nullable, {**field.metadata, IDENTITY: True})


def insert_columns(spark: SparkSession, table: str) -> list[str]:
    """The columns an insert names: those of the catalog in ordinal order, without
    identity columns.  The table's name is matched without case and outer blanks."""
    return [c.name for c in spark.catalog.listColumns(table.strip().lower()) if c.description != IDENTITY]


def append_by_name(df: DataFrame, table: str) -> None:
    """Append ``df`` to ``table`` by column name: columns that ``df`` lacks become
    NULL, the order of its columns does not matter, and one that the table lacks
    raises a ValueError before anything is written."""
    spark = df.sparkSession
    target = spark.table(table).schema
    have = {c.lower() for c in df.columns}
    unknown = sorted(have - {f.name.lower() for f in target})
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(unknown)}")
    if len(have) < len(df.columns):
        raise ValueError(f"columns named twice: {', '.join(df.columns)}")
    rows = df.select(*[(F.col(f"`{f.name}`").cast(f.dataType) if f.name.lower() in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in target])
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=rows)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of ``table`` that ``df`` has rows for; the files of all
    others stay.  ``df`` may be computed from the table: it is stored first, so that
    a lost executor never reads what is being replaced."""
    spark = df.sparkSession
    rows = cut_lineage(df.select(*spark.table(table).columns))
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.write.mode("overwrite").insertInto(table)


def table_statistics(spark: SparkSession, table: str) -> dict[str, int]:
    """size_bytes and, once computed, row_count of a catalog table."""
    for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect():
        if r.col_name == "Statistics":
            size, _, rows = r.data_type.partition(" bytes")
            out = {"size_bytes": int(size)}
            return out | ({"row_count": int(rows.strip(", ").removesuffix(" rows"))} if "rows" in rows else {})
    return {}


def column_statistics(spark: SparkSession, table: str, column: str) -> dict[str, str]:
    """Statistics of one column as the catalog has them (empty if none)."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table} `{column}`").collect()
    return {r.info_name: r.info_value for r in rows if r.info_value not in (None, "NULL")
            and r.info_name not in ("col_name", "data_type", "comment")}
