"""Batch control: audit rows and metadata-driven SQL steps.

* ``audit_open`` appends the row that opens a batch; ``audit_close`` closes the
  latest open row of a batch (max audit id with no end time).  Both are
  DataFrame rewrites; ``operators.batch`` does the same to a stored audit table.
* ``valid_steps`` lists the transformation steps of one source and work table
  that are valid on a date, in sequence order, with their text flattened to
  one line; ``run_steps`` executes them through ``spark.sql``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import flatten_whitespace
from ..functions.validity import date_lit


def _ts(value) -> Column:
    if value is None:
        return F.localtimestamp()
    return F.lit(str(value)).cast("timestamp_ntz")


def audit_open_row(batches: DataFrame, batch_name: str, scheduler: str, status: str, now=None) -> DataFrame:
    """The opening row of ``batch_name``: start = now, no end, the given status; the
    id continues the table's identity (max id + 1)."""
    return batches.agg((F.coalesce(F.max("audit_id"), F.lit(0)) + 1).cast("int").alias("audit_id")) \
        .select("audit_id",
                F.lit(batch_name).alias("batch_name"), F.lit(scheduler).alias("scheduler"),
                _ts(now).alias("batch_start_dtm"), F.lit(None).cast("timestamp_ntz").alias("batch_end_dtm"),
                F.lit(status).alias("batch_load_stus_ind"), _ts(now).alias("row_process_dtm"))


def audit_open(batches: DataFrame, batch_name: str, scheduler: str, status: str,
               now=None) -> DataFrame:
    """Append the opening row of ``batch_name``."""
    return batches.unionByName(audit_open_row(batches, batch_name, scheduler, status, now))


def open_audit_id(batches: DataFrame, batch_name: str) -> Column:
    """Scalar subquery: latest open audit id of ``batch_name`` (NULL if none)."""
    return (batches.filter(F.col("batch_end_dtm").isNull() & (F.col("batch_name") == batch_name))
                   .agg(F.max("audit_id")).scalar())


def audit_close(batches: DataFrame, batch_name: str, status: str, now=None) -> DataFrame:
    """Close the latest open row of ``batch_name``: end = now, new status and
    process time.  Every other row is unchanged."""
    return close_row(batches, F.col("audit_id") == open_audit_id(batches, batch_name), status, now)


def close_row(batches: DataFrame, which: Column, status: str, now=None) -> DataFrame:
    """``batches`` with the row that ``which`` picks closed."""
    hit = F.coalesce(which, F.lit(False))
    return batches.select(*[
        (F.when(hit, _ts(now)).otherwise(F.col(c)).alias(c) if c in ("batch_end_dtm", "row_process_dtm")
         else F.when(hit, F.lit(status)).otherwise(F.col(c)).alias(c) if c == "batch_load_stus_ind"
         else F.col(c))
        for c in batches.columns])


def _match(col: str, value: str) -> Column:
    return F.lower(F.trim(F.col(col))) == F.lower(F.trim(F.lit(value)))


def step_count(steps: DataFrame, source_cd: str, work_table: str) -> DataFrame:
    """Number of steps defined for a source and work table (valid or not)."""
    return steps.filter(_match("source_cd", source_cd) & _match("work_table", work_table)) \
                .agg(F.count(F.lit(1)).alias("step_count"))


def all_valid_steps(steps: DataFrame, today: str | _dt.date) -> DataFrame:
    """Steps valid on ``today`` for every (source, work table), numbered in
    sequence order within their pair, text flattened to one line."""
    d = date_lit(today)
    src = F.lower(F.trim("source_cd"))
    wt = F.lower(F.trim("work_table"))
    w = Window.partitionBy(src, wt).orderBy("transformation_seq")
    return (steps.filter(d.between(F.col("valid_from"), F.col("valid_to")))
                 .select(src.alias("source_key"), wt.alias("work_table_key"),
                         F.row_number().over(w).alias("step_index"),
                         F.col("transformation_seq").cast("string").alias("transformation_seq"),
                         F.coalesce(flatten_whitespace("transformation_desc"), F.lit(""))
                         .alias("transformation_desc"),
                         flatten_whitespace("sql_statement").alias("sql_statement")))


def valid_steps(steps: DataFrame, source_cd: str, work_table: str,
                today: str | _dt.date) -> DataFrame:
    """The runnable steps of one source and work table, in order."""
    return all_valid_steps(steps, today).filter(
        (F.col("source_key") == source_cd.strip().lower())
        & (F.col("work_table_key") == work_table.strip().lower()))


def single_step(steps: DataFrame, source_cd: str, work_table: str, today, seq: int) -> DataFrame:
    """The one step with sequence ``seq`` (must exist and be valid today)."""
    return valid_steps(steps, source_cd, work_table, today) \
        .filter(F.col("transformation_seq") == str(seq)).drop("step_index")


def run_steps(spark: SparkSession, steps: DataFrame, source_cd: str, work_table: str,
              today, seq: int | None = None) -> list[tuple[str, DataFrame]]:
    """Execute the valid steps in order (or only step ``seq``) with
    ``spark.sql``; returns (sequence, result) pairs.  Only the step texts of
    one work table reach the driver -- a control list, not data."""
    sel = (single_step(steps, source_cd, work_table, today, seq) if seq is not None
           else valid_steps(steps, source_cd, work_table, today))
    rows = sel.orderBy(F.col("transformation_seq").cast("int")).collect()
    if seq is not None and not rows:
        raise LookupError(f"step {seq} of {work_table} is missing or not valid on {today}")
    return [(r["transformation_seq"], spark.sql(r["sql_statement"])) for r in rows]
