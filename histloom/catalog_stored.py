"""Registered queries over stored tables: histories, audit and step log in the
catalog.  The tables are written from the stand-in sources by the query itself."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import AS_OF, register
from .catalog_ops import AUDIT_NOW, OLD_CUTOFF, _history_case
from .operators import batch
from .operators.history import classify_changes, reflag_current
from .plans import address, agreement, party
from .plans.spec import checked_output, run_load, run_stored, target_columns
from .sources.fixtures import PARTICIPANTS, Sources, load_sources
from .sources.history_table import HistoryTable
from .sources.io import cut_lineage, cuts_made, refresh_statistics, release_cuts, scratch_path
from .sources.tables import append_by_name, column_statistics, insert_columns, scratch_table, table_statistics
from .sources.versions import VersionedTable
from .plans.targets import struct_type

#: Buckets of the stored histories of these queries (a load of production size takes
#: about one per 256 MB of open versions).
BUCKETS = 8

#: Steps of ``step_log_resume`` that may run side by side: each only counts rows of one table.
STEPS_AHEAD = 12


@register("catalog_columns")
def q_catalog_columns(spark, sf):
    """The columns an insert into the stored audit table names, in ordinal order, with
    the statistics the catalog has of them after a refresh."""
    name = batch.audit_table(spark, load_sources(spark, sf).batches)
    columns = [c for c in insert_columns(spark, name) if c != batch.MONTH]
    refresh_statistics(spark, name, columns)
    rows = table_statistics(spark, name)["row_count"]
    got = [(i, c, rows, int(column_statistics(spark, name, c)["num_nulls"])) for i, c in enumerate(columns, 1)]
    return spark.createDataFrame(got, "ordinal_position int, column_name string, row_count long, null_count long")


@register("reload_from_own_target")
def q_reload_from_own_target(spark, sf):
    """Party history kept in one versioned table: three batches, each read from the
    table that it reloads, with the flag settled over all versions."""
    src = load_sources(spark, sf)
    changed = Sources({**src.frames, "src_sponsor": src.sponsor.withColumn(
        "spnsr_cmpny_nm", F.when(F.col("spnsr_cmpny_key") % 3 == 0, F.concat("spnsr_cmpny_nm", F.lit("II")))
        .otherwise(F.col("spnsr_cmpny_nm")))})
    spec = party.LOAD_PARTY
    table = VersionedTable(spark, scratch_path(spark, f"versions-{uuid.uuid4().hex}"))
    for number, part in enumerate((src, changed, changed), 1):
        stored = table.read()
        new = run_load(spec, part, stored, AS_OF, F.lit(f"2001-01-0{number} 06:00:00"))
        table.reload(new if stored is None else reflag_current(stored.unionByName(new), spec.keys))
    return checked_output(table.read())


@register("audit_close_in_place")
def q_audit_close_in_place(spark, sf):
    """A batch closed in the stored audit table; ``rewritten`` tells the rows whose
    file is a new one."""
    name = batch.audit_table(spark, load_sources(spark, sf).batches)
    here = F.col("_metadata.file_path").alias("file")
    before = cut_lineage(spark.table(name).select(here).distinct().withColumn("old", F.lit(True)))
    batch.close_stored(spark, name, "batch_2", "S", AUDIT_NOW)
    rows = spark.table(name).select("*", here).join(before, "file", "left")
    out = rows.withColumn("rewritten", F.col("old").isNull()).drop("file", "old", batch.MONTH)
    return checked_output(out.withColumnRenamed("row_process_dtm", "processed_dtm"))


@register("append_by_name")
def q_append_by_name(spark, sf):
    """The three address loads, each compared with the stored table and appended to it
    by its own column list (all-NULL columns are left to the table)."""
    start = cuts_made()
    src = load_sources(spark, sf, PARTICIPANTS)
    layout = target_columns(address.ADDRESS_LOADS[0].layout)
    name = scratch_table(spark, "address", struct_type(layout))
    for spec in address.ADDRESS_LOADS:
        made = cuts_made()
        new = run_load(spec, src, spark.table(name), AS_OF)
        mine = [c for c in reversed(new.columns) if c not in ("address_street_4_txt", "address_validation_cde")]
        append_by_name(new.select(*mine), name)
        release_cuts(spark, made)
    release_cuts(spark, start)
    refresh_statistics(spark, name)
    return checked_output(spark.table(name))


def _stored_history(spark, layout, keys, history: DataFrame, buckets: int) -> HistoryTable:
    table = HistoryTable.create(spark, "history", layout, keys, buckets)
    table.append(history)
    refresh_statistics(spark, table.name)
    return table


def _classify_stored(spark, sf, buckets):
    spec, _, history, rows = _history_case(spark, sf)
    table = _stored_history(spark, target_columns(spec.layout), spec.keys, history, buckets)
    return checked_output(table.classify(rows))


@register("classify_bucketed_target")
def q_classify_bucketed_target(spark, sf):
    """Change capture against a stored history bucketed on its natural key."""
    return _classify_stored(spark, sf, BUCKETS)


@register("classify_partitioned_target")
def q_classify_partitioned_target(spark, sf):
    """Change capture against a stored history whose closed versions are not listed."""
    return _classify_stored(spark, sf, 0)


@register("classify_reduced_target")
def q_classify_reduced_target(spark, sf):
    """Change capture against a history reduced by a Bloom filter of the batch's keys."""
    spec, _, history, rows = _history_case(spark, sf)
    return checked_output(classify_changes(rows, history, spec.keys, reduce=True))


def _stored_batches(spark, sf, specs, change):
    """Three batches into one bucketed, partitioned history: base, changed, unchanged."""
    src = load_sources(spark, sf)
    changed = Sources({**src.frames, **change(src)})
    table = HistoryTable.create(spark, "batches", target_columns(specs[0].layout), specs[0].keys, BUCKETS)
    out = []
    for number, part in enumerate((src, changed, changed), 1):
        new = run_stored(specs, part, table, AS_OF, F.lit(f"2001-01-0{number} 06:00:00"))
        out += [checked_output(n).withColumn("batch_no", F.lit(number)) for n in new]
    return reduce(DataFrame.unionByName, out)


@register("load_party_stored")
def q_load_party_stored(spark, sf):
    return _stored_batches(spark, sf, [party.LOAD_PARTY], lambda src: {"src_sponsor": src.sponsor.withColumn(
        "spnsr_cmpny_nm", F.when(F.col("spnsr_cmpny_key") % 3 == 0, F.concat("spnsr_cmpny_nm", F.lit("II")))
        .otherwise(F.col("spnsr_cmpny_nm")))})


@register("load_agreement_stored")
def q_load_agreement_stored(spark, sf):
    return _stored_batches(spark, sf, [agreement.LOAD_CUSTOMER_AGREEMENT], lambda src: {
        "src_agreement_hist": src.agreement_hist.withColumn("hldg_stus", F.concat("hldg_stus", F.lit("2")))})


@register("reflag_stored_history")
def q_reflag_stored_history(spark, sf):
    """Old and new versions appended to a stored history, then the flag settled by
    rewriting the partition of open versions."""
    spec, src, history, _ = _history_case(spark, sf)
    history = cut_lineage(history)
    table = _stored_history(spark, target_columns(spec.layout), spec.keys, history, BUCKETS)
    table.append(run_load(spec, src, table, AS_OF, F.lit("2100-01-01 06:00:00")))
    table.reflag()
    return checked_output(table.read())


@register("step_log_resume")
def q_step_log_resume(spark, sf):
    """Steps of one work table: a run that fails at the middle step, then one that goes
    on from there.  One row per logged step with the count its statement gave.  The steps only
    read, so several run at a time; they are logged in order."""
    src = load_sources(spark, sf)
    spark.read.parquet(f"{sf}/supplier.parquet").createOrReplaceTempView("supplier")
    log = batch.log_table(spark)
    audit = batch.audit_table(spark, src.batches)
    valid = batch.control.valid_steps(src.steps, "TRAC", "DIM_PLAN", AS_OF)
    last = valid.agg(F.max("step_index").alias("m")).first()["m"]
    broken = valid.where(F.col("step_index") == (last + 1) // 2).select(F.col("transformation_seq").cast("int").alias("seq"))
    first = src.steps.join(broken, F.col("transformation_seq") == F.col("seq"), "left").withColumn(
        "sql_statement", F.when(F.col("seq").isNotNull(), F.lit("select n from a_table_that_is_missing"))
        .otherwise(F.col("sql_statement"))).drop("seq")

    def execute(seq: int, result: DataFrame) -> str:
        return str(result.first().n)

    args = ("TRAC", "DIM_PLAN", AS_OF, log, "plan_load", execute, audit)
    try:
        batch.run_logged(spark, first, *args, ahead=STEPS_AHEAD)
        raise AssertionError("the broken step did not fail")
    except batch.StepFailed:
        batch.run_logged(spark, src.steps, *args, analyze=log, ahead=STEPS_AHEAD)
    done = F.col("status") == batch.DONE
    return spark.table(log).select(
        "transformation_seq", "attempt", "status", F.when(done, F.col("message")).cast("long").alias("n"),
        (~done & F.col("message").isNotNull()).alias("has_message"))
