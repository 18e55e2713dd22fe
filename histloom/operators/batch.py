"""Batches over stored tables: the audit table in the catalog, and a step runner
that logs every step and resumes behind the last one that succeeded."""

from __future__ import annotations

import datetime as _dt
from collections import deque
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources.io import refresh_statistics
from ..sources.tables import append_by_name, identity, overwrite_partitions, scratch_table
from . import control

#: Partition of the audit table: the month in which a batch began.
MONTH = "batch_month"
#: Status of a step or batch: succeeded or failed.
DONE, FAILED = "S", "F"
LOG = ("run_id string, source_cd string, work_table string, transformation_seq int, attempt int, "
       "status string, start_dtm timestamp_ntz, end_dtm timestamp_ntz, message string")


def _month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.date_format("batch_start_dtm", "yyyy-MM"))


def audit_table(spark: SparkSession, batches: DataFrame) -> str:
    """A stored audit table with the rows of ``batches``, partitioned by month; the
    audit id is its identity column."""
    schema = StructType([identity(f) if f.name == "audit_id" else f for f in batches.schema]
                        + [StructField(MONTH, StringType())])
    name = scratch_table(spark, "audit", schema, [MONTH])
    append_by_name(_month(batches).repartition(MONTH), name)
    return name


def open_stored(spark: SparkSession, table: str, batch_name: str, scheduler: str, status: str, now=None) -> int:
    """Append the opening row of ``batch_name`` and refresh the table's statistics;
    returns the new audit id."""
    rows = spark.table(table).drop(MONTH)
    new = control.audit_open_row(rows, batch_name, scheduler, status, now)
    audit_id = new.first()["audit_id"]
    append_by_name(_month(new.withColumn("audit_id", F.lit(audit_id))), table)
    refresh_statistics(spark, table, ["audit_id", "batch_name", "batch_end_dtm"])
    return audit_id


def close_stored(spark: SparkSession, table: str, batch_name: str, status: str, now=None) -> int | None:
    """Close the latest open row of ``batch_name`` in place: only the partition that
    holds it is rewritten.  Returns its audit id; None, and nothing is written, if
    the batch has no open row."""
    rows = spark.table(table)
    hit = rows.where(F.col("batch_end_dtm").isNull() & (F.col("batch_name") == batch_name)).agg(
        F.max(F.struct("audit_id", MONTH)).alias("m")).select("m.*").first()
    if hit["audit_id"] is None:
        return None
    part = rows.where(F.col(MONTH).eqNullSafe(F.lit(hit[MONTH])))
    closed = control.close_row(part, F.col("audit_id") == hit["audit_id"], status, now)
    overwrite_partitions(closed, table)
    refresh_statistics(spark, table, ["audit_id", "batch_name", "batch_end_dtm"])
    return hit["audit_id"]


def log_table(spark: SparkSession) -> str:
    return scratch_table(spark, "steplog", StructType.fromDDL(LOG))


class StepFailed(RuntimeError):
    """A step raised; what ran before it is logged as done."""


class _LogWriter:
    """Appends log rows while the next step runs: one INSERT at a time, with all rows
    that have come since the last one began, in order."""

    def __init__(self, spark: SparkSession, log: str):
        self.spark, self.log, self.waiting = spark, log, []
        self.pool, self.busy = ThreadPoolExecutor(1), Future()
        self.busy.set_result(None)

    def add(self, row: dict) -> None:
        self.waiting.append(row)
        if self.busy.done():
            self._start()

    def _start(self) -> None:
        self.busy.result()                     # raises what the last INSERT raised
        rows, self.waiting = self.waiting, []
        self.busy = self.pool.submit(self._insert, rows)

    def _insert(self, rows: list[dict]) -> None:
        types = {"start": "TIMESTAMP_NTZ", "end": "TIMESTAMP_NTZ", "message": "STRING"}
        values = ", ".join("(" + ", ".join(f"CAST(:{c}{i} AS {types[c]})" if c in types else f":{c}{i}" for c in row) + ")"
                           for i, row in enumerate(rows))
        self.spark.sql(f"INSERT INTO {self.log} (run_id, source_cd, work_table, transformation_seq, attempt, status, "
                       f"start_dtm, end_dtm, message) VALUES {values}",
                       {f"{c}{i}": v for i, row in enumerate(rows) for c, v in row.items()})

    def close(self) -> None:
        """Returns once every row is in the table."""
        try:
            self.busy.result()
            if self.waiting:
                self._start()
                self.busy.result()
        finally:
            self.pool.shutdown()


def run_logged(spark: SparkSession, steps: DataFrame, source_cd: str, work_table: str, today, log: str, run_id: str,
               execute: Callable[[int, DataFrame], str | None], audit: str | None = None, scheduler: str = "cron",
               analyze: str | None = None, ahead: int = 1) -> list[int]:
    """Run the valid steps in order, one log row each (status, start, end, message), stored
    while the next step runs: if the driver is lost, so may be the rows of the steps that ended
    during the last INSERT, and these run again.

    The first failure is logged, ends the run and raises ``StepFailed``.  The same
    ``run_id`` run again goes on behind the steps that are logged as done.  With
    ``audit`` each run opens a row of the batch ``run_id`` there and closes it with
    the outcome; ``analyze`` names a table whose statistics are refreshed at the end.
    ``execute`` takes a step's number and the DataFrame of its statement, and may
    return a text for the log.  Returns the numbers of the steps that ran.  Only one work table's step texts and log
    rows reach the driver.

    Each step waits for the one before it, unless ``ahead`` is more than 1: then up to so many run side by
    side, from threads of their own, and are logged in order.  That is for steps that read nothing another one
    writes.  Behind a failed step up to ``ahead - 1`` have begun by then; they are waited for, count as not
    run and run again with the rest."""
    past = spark.table(log).where((F.col("run_id") == run_id) & F.lower("work_table").eqNullSafe(work_table.strip().lower()))
    known = past.groupBy("transformation_seq").agg(
        F.max("attempt").alias("attempt"), F.bool_or(F.col("status") == DONE).alias("done")).collect()
    done = {r.transformation_seq for r in known if r.done}
    attempts = {r.transformation_seq: r.attempt for r in known}
    todo = [r for r in control.valid_steps(steps, source_cd, work_table, today).orderBy("step_index").collect()
            if int(r.transformation_seq) not in done]
    if audit:
        open_stored(spark, audit, run_id, scheduler, "I")
    def attempt(seq: int, text: str) -> tuple[str, str, str | None, Exception | None]:
        start, message, error = _now(), None, None
        try:
            message = execute(seq, spark.sql(text))
        except Exception as e:  # whatever a step raises belongs in the log
            error, message = e, f"{type(e).__name__}: {e}"[:1000]
        return start, _now(), message, error

    ran, writer, failed = [], _LogWriter(spark, log), None
    pool, begun = ThreadPoolExecutor(ahead), deque()
    try:
        for i in range(len(todo)):
            for r in todo[i + len(begun):i + ahead]:
                begun.append(pool.submit(attempt, int(r.transformation_seq), r.sql_statement))
            seq = int(todo[i].transformation_seq)
            start, end, message, error = begun.popleft().result()
            writer.add({"run": run_id, "source": source_cd.strip(), "work": work_table.strip(), "seq": seq,
                        "attempt": attempts.get(seq, 0) + 1, "status": FAILED if error else DONE,
                        "start": start, "end": end, "message": message})
            if error:
                failed = StepFailed(f"step {seq} of {work_table}: {message}")
                failed.__cause__ = error
                break
            ran.append(seq)
    finally:
        pool.shutdown(cancel_futures=True)
        writer.close()
    if failed:
        if audit:
            close_stored(spark, audit, run_id, FAILED)
        raise failed
    if analyze:
        refresh_statistics(spark, analyze)
    if audit:
        close_stored(spark, audit, run_id, DONE)
    return ran


def _now() -> str:
    return _dt.datetime.now().isoformat(sep=" ")
