"""Stored tables: columns and statistics of the catalog, appends by name, reloads from
the own target, partitions rewritten in place, stored histories, step log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from histloom.operators import batch, control
from histloom.operators.history import classify_changes, open_versions, reflag_current
from histloom.operators.keyfilter import MAX_BITS, bits_for, key_filter, may_have, reduce_by_keys
from histloom.plans import address, party
from histloom.plans.spec import run_load, run_loads, run_stored, target_columns
from histloom.sources.history_table import HistoryTable
from histloom.sources.io import refresh_statistics
from histloom.sources.tables import (append_by_name, column_statistics, create_table, drop_scratch_tables, identity,
                                     insert_columns, overwrite_partitions, scratch_table, table_statistics)
from histloom.sources.versions import ConflictError, VersionedTable

AS_OF = "2001-01-01"


@pytest.fixture(autouse=True)
def _drop(spark):
    yield
    drop_scratch_tables(spark)


def files(spark, name, where="true"):
    return {r[0] for r in spark.table(name).where(where).select("_metadata.file_path").distinct().collect()}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def above(text, name):
    """Names of the operators above the line that holds ``name``, from below."""
    lines = text.splitlines()
    at = next(i for i, x in enumerate(lines) if name in x)
    depth, out = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789")), []
    for x in reversed(lines[:at]):
        d = len(x) - len(x.lstrip(" :+-*()0123456789"))
        if x.strip() and d < depth:
            out.append(x.strip(" :+-*()0123456789"))
            depth = d
    return out


# -- catalog columns, appends, statistics ---------------------------------------------

SCHEMA = StructType([identity(StructField("id", IntegerType())), StructField("b", StringType()),
                     StructField("a", IntegerType())])


def test_insert_columns_are_the_catalogs_without_identity(spark):
    name = scratch_table(spark, "cols", SCHEMA)
    assert insert_columns(spark, f"  {name.upper()} ") == ["b", "a"]


def test_partition_columns_come_last(spark):
    name = scratch_table(spark, "cols", SCHEMA, ["b"])
    assert insert_columns(spark, name) == ["a", "b"]


def test_append_by_name(spark):
    name = scratch_table(spark, "app", SCHEMA)
    append_by_name(spark.createDataFrame([(7, 1)], "A int, id int"), name)           # order and case
    append_by_name(spark.createDataFrame([("x",)], "b string"), name)                # padded
    append_by_name(spark.createDataFrame([], "a int"), name)
    assert rows(spark.table(name)) == [(1, None, 7), (None, "x", None)]
    for bad in ("z int", "a int, zz int"):
        with pytest.raises(ValueError, match="has no column z"):
            append_by_name(spark.createDataFrame([], bad), name)
    with pytest.raises(ValueError, match="twice"):
        append_by_name(spark.createDataFrame([(1, 2)], "a int, b int").select("a", F.col("b").alias("a")), name)
    assert spark.table(name).count() == 2


def test_three_appends_equal_the_fold(spark, src):
    layout = target_columns(address.ADDRESS_LOADS[0].layout)
    table = HistoryTable.create(spark, "addr", layout, address.ADDRESS_KEY)
    run_stored(address.ADDRESS_LOADS, src, table, AS_OF, F.lit("2001-01-01 06:00:00"))
    fold = run_loads(address.ADDRESS_LOADS, src, as_of=AS_OF, process_ts=F.lit("2001-01-01 06:00:00"))
    assert rows(table.read().select(*fold.columns)) == rows(fold)


def test_statistics_reach_the_optimiser(spark):
    name = scratch_table(spark, "stats", SCHEMA)
    append_by_name(spark.range(1000).select(F.col("id").cast("int").alias("a"),
                                            F.when(F.col("id") < 900, F.lit("x")).alias("b")), name)

    def estimate():
        return spark.table(name).where("b IS NULL")._jdf.queryExecution().optimizedPlan().stats()
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        assert "row_count" not in table_statistics(spark, name) and not column_statistics(spark, name, "a")
        before = estimate().sizeInBytes()
        refresh_statistics(spark, name, ["a", "b"])
        assert table_statistics(spark, name)["row_count"] == 1000
        assert column_statistics(spark, name, "b")["num_nulls"] == "100"
        a = column_statistics(spark, name, "a")
        assert (a["min"], a["max"], a["num_nulls"]) == ("0", "999", "0")
        after = estimate()
        assert after.rowCount().get() == 100 and after.sizeInBytes() != before
    finally:
        spark.conf.set("spark.sql.cbo.enabled", "false")


def test_create_table_refuses_a_known_name(spark):
    name = scratch_table(spark, "twice", SCHEMA)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_table(spark, name, SCHEMA)


# -- reload from the own target -----------------------------------------------------------

def test_reload_reads_the_table_it_replaces(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    assert table.read() is None and table.versions() == [] and table.recover() == []
    assert table.reload(spark.range(3)) == 1
    for _ in range(3):
        table.reload(table.read().selectExpr("id * 2 AS id").union(table.read()))
    assert table.read().count() == 24 and table.versions() == [1, 2, 3, 4]
    assert table.read(1).count() == 3
    assert len(table.recover(keep=2)) == 2
    assert table.versions() == [3, 4] and table.read().count() == 24 and table.read(3).count() == 12


def test_a_run_that_dies_before_its_commit_changes_nothing(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    table.reload(spark.range(5))
    left = table.stage(table.read().selectExpr("id + 100 AS id"))      # written, then the driver dies
    again = VersionedTable(spark, f"{tmp_path}/t")
    assert rows(again.read()) == [(i,) for i in range(5)]
    assert again.recover() == [left]
    assert again.reload(again.read().selectExpr("id + 1 AS id")) == 2
    assert rows(again.read()) == [(i + 1,) for i in range(5)]


def test_a_folder_not_written_in_full_is_not_committed(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    table.reload(spark.range(5))
    with pytest.raises(Exception):
        table.reload(table.read().select(F.raise_error(F.lit("stop")).alias("id")))
    with pytest.raises(FileNotFoundError):
        table.commit("nothing", 2)
    assert table.versions() == [1] and table.read().count() == 5


def test_of_two_writers_one_loses(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    table.reload(spark.range(1))
    a, b = table.stage(spark.range(2)), table.stage(spark.range(3))
    table.commit(a, 2)
    with pytest.raises(ConflictError):
        table.commit(b, 2)
    assert table.read().count() == 2 and table.recover() and table.read().count() == 2


# -- the stored audit table --------------------------------------------------------------

def test_close_rewrites_one_partition(spark, src):
    name = batch.audit_table(spark, src.batches)
    want = rows(control.audit_close(src.batches, "batch_2", "S", "2001-01-01 06:00:00"))
    hit = src.batches.where("batch_end_dtm IS NULL AND batch_name = 'batch_2'").agg(F.max("audit_id")).first()[0]
    month = spark.table(name).where(F.col("audit_id") == hit).first()[batch.MONTH]
    other, own = files(spark, name, f"batch_month <> '{month}'"), files(spark, name, f"batch_month = '{month}'")
    assert batch.close_stored(spark, name, "batch_2", "S", "2001-01-01 06:00:00") == hit
    assert rows(spark.table(name).drop(batch.MONTH)) == want
    assert files(spark, name, f"batch_month <> '{month}'") == other
    assert not files(spark, name, f"batch_month = '{month}'") & own
    assert table_statistics(spark, name)["row_count"] == len(want)


def test_close_without_an_open_row_writes_nothing(spark, src):
    name = batch.audit_table(spark, src.batches.where("batch_end_dtm IS NOT NULL"))
    before = files(spark, name)
    assert batch.close_stored(spark, name, "batch_2", "S") is None
    assert batch.close_stored(spark, name, "no such batch", "S") is None
    assert files(spark, name) == before


def test_open_appends_and_refreshes(spark, src):
    name = batch.audit_table(spark, src.batches)
    before, n = files(spark, name), src.batches.count()
    audit_id = batch.open_stored(spark, name, "new", "cron", "I", "2001-01-01 06:00:00")
    assert audit_id == src.batches.agg(F.max("audit_id")).first()[0] + 1
    assert before < files(spark, name) and table_statistics(spark, name)["row_count"] == n + 1
    assert int(column_statistics(spark, name, "audit_id")["max"]) == audit_id
    assert batch.close_stored(spark, name, "new", "S") == audit_id
    empty = batch.audit_table(spark, src.batches.limit(0))
    assert batch.open_stored(spark, empty, "new", "cron", "I") == 1


def test_overwrite_partitions_keeps_the_session_setting(spark):
    name = scratch_table(spark, "dyn", SCHEMA, ["b"])
    append_by_name(spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string"), name)
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    overwrite_partitions(spark.table(name).where("b = 'x'").withColumn("a", F.col("a") * 10), name)
    assert rows(spark.table(name).select("a", "b")) == [(10, "x"), (2, "y")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == old


# -- stored histories ------------------------------------------------------------------------

LAYOUT = [("k1", "string"), ("k2", "int"), ("begin_dt", "date"), ("row_process_dtm", "timestamp_ntz"), ("audit_id", "int"),
          ("check_sum", "string"), ("current_row_ind", "boolean"), ("end_dt", "date")]
KEYS = ("k1", "k2")


def versions(spark, n, seed, keys=300, hot=0.0):
    """Versions with hot, NULL and closed keys and several current rows per key."""
    r = [F.pmod(F.xxhash64("id", F.lit(seed * 10 + i)), F.lit(1_000_000)) / 1_000_000 for i in range(5)]
    key = F.when(r[0] < hot, "hot").when(r[0] > 0.97, F.lit(None)).otherwise(F.concat(F.lit("k"), F.floor(r[1] * keys)))
    end = F.when(r[2] < 0.7, F.lit("9999-12-31")).otherwise(F.lit("2000-06-30")).cast("date")
    return spark.range(n).select(
        key.alias("k1"), F.when(key == "hot", 1).otherwise(F.floor(r[3] * 2)).cast("int").alias("k2"),
        F.lit("1999-01-01").cast("date").alias("begin_dt"), F.lit("2001-01-01 06:00:00").cast("timestamp_ntz").alias("row_process_dtm"),
        F.floor(r[4] * 3).cast("int").alias("audit_id"), F.concat(F.lit("s"), F.floor(r[3] * 7)).alias("check_sum"),
        (r[2] < 0.6).alias("current_row_ind"), end.alias("end_dt"))


@pytest.mark.parametrize("buckets,salts", [(0, 1), (4, 1), (4, 3)])
def test_stored_classification_equals_the_plain_one(spark, buckets, salts):
    history, batch_rows = versions(spark, 3000, 1, hot=0.3), versions(spark, 400, 2, hot=0.3).drop("current_row_ind")
    table = HistoryTable.create(spark, "h", LAYOUT, KEYS, buckets, salts)
    assert rows(table.classify(batch_rows)) == rows(classify_changes(batch_rows, None, KEYS).where("true"))
    table.append(history)
    want = rows(classify_changes(batch_rows, history, KEYS))
    assert {r[-1] for r in want} == {"I", "U", "D"}
    assert rows(table.classify(batch_rows)) == want
    assert rows(classify_changes(batch_rows, history, KEYS, reduce=True)) == want
    only = F.col("audit_id") == 1
    assert rows(table.classify(batch_rows, only)) == rows(classify_changes(batch_rows, history, KEYS, only))
    assert rows(table.read()) == rows(history)


def test_bucketed_target_is_not_moved(spark):
    """Without any broadcast, no exchange lies between the stored history and the
    aggregate of what the batch hits."""
    table = HistoryTable.create(spark, "h", LAYOUT, KEYS, 4, 3)
    table.append(versions(spark, 3000, 1))
    table.append(versions(spark, 500, 3))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = table.classify(versions(spark, 100, 2).drop("current_row_ind"))
        ops = above(plan(out), f"Scan parquet spark_catalog.default.{table.name}" if "spark_catalog.default" in plan(out)
                    else "FileScan parquet")
        moved = next(i for i, x in enumerate(ops) if x.startswith("Exchange"))
        below = ops[:moved]
        assert any("LeftSemi" in x for x in below) and sum("Aggregate" in x for x in below) >= 2, ops
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_key_is_dealt_over_buckets(spark):
    table = HistoryTable.create(spark, "h", LAYOUT, KEYS, 16, 8)
    hot = spark.range(4000).select(F.lit("hot").alias("k1"), F.lit(1).alias("k2"), F.col("id").cast("int").alias("audit_id"),
                                   F.lit("s").alias("check_sum"), F.lit(True).alias("current_row_ind"),
                                   F.lit("9999-12-31").cast("date").alias("end_dt"))
    table.append(hot)
    sizes = [r["count"] for r in spark.table(table.name).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)


def test_closed_versions_are_not_listed(spark):
    table = HistoryTable.create(spark, "h", LAYOUT, KEYS)
    table.append(versions(spark, 3000, 1))
    cur = table.open_versions()
    assert "PartitionFilters: [isnotnull(open_ind" in plan(cur) or "open_ind#" in plan(cur).split("PartitionFilters: [")[1]
    assert cur.inputFiles() and all("open_ind=true" in f for f in cur.inputFiles())
    assert len(cur.inputFiles()) < len(table.read().inputFiles())
    assert rows(cur.drop("key_salt", "open_ind")) == rows(open_versions(table.read(), KEYS))


@pytest.mark.parametrize("buckets", [0, 4])
def test_reflag_rewrites_open_versions_only(spark, buckets):
    table = HistoryTable.create(spark, "h", LAYOUT, KEYS, buckets, 3)
    table.append(versions(spark, 2000, 1, hot=0.2))
    table.append(versions(spark, 300, 2, hot=0.2))
    want = rows(reflag_current(table.read(), KEYS))
    closed, opened = files(spark, table.name, "NOT open_ind"), files(spark, table.name, "open_ind")
    table.reflag()
    assert rows(table.read()) == want
    assert files(spark, table.name, "NOT open_ind") == closed and not files(spark, table.name, "open_ind") & opened


def test_reload_of_a_stored_history_adds_nothing_current(spark, src):
    spec = party.LOAD_PARTY
    table = HistoryTable.create(spark, "h", target_columns(spec.layout), spec.keys, 4)
    run_stored([spec], src, table, AS_OF)
    assert run_load(spec, src, table, AS_OF).where("current_row_ind").count() == 0


# -- the Bloom filter --------------------------------------------------------------------------

def test_key_filter_loses_no_key_and_drops_most_others(spark):
    target = spark.range(50_000).select(F.concat(F.lit("k"), "id").alias("k1"), (F.col("id") % 5).cast("int").alias("k2"))
    batch_rows = target.where("k1 LIKE '%77'").union(spark.createDataFrame([("absent", 1), (None, 2), ("k3", None)], "k1 string, k2 int"))
    n = batch_rows.count()
    kept = reduce_by_keys(target, batch_rows, KEYS)
    assert rows(kept.intersect(batch_rows)) == rows(target.intersect(batch_rows))
    assert kept.count() < n + 0.05 * 50_000
    assert reduce_by_keys(target, batch_rows.limit(0), KEYS).count() == 0
    assert rows(reduce_by_keys(target, batch_rows, KEYS, n_keys=1).intersect(batch_rows)) == rows(target.intersect(batch_rows))


def test_filter_size_is_bounded(spark):
    assert bits_for(0) == 64 and bits_for(1000) == 10_048 and bits_for(10 ** 7) == MAX_BITS and bits_for(10 ** 8) == 0
    target = spark.range(10).select(F.col("id").alias("k"))
    assert reduce_by_keys(target, target, ["k"], n_keys=10 ** 9).count() == 10       # beyond it, nothing is dropped
    bits = bits_for(3)
    f = key_filter(target.where("k < 3"), ["k"], bits)
    assert rows(target.where("k < 3").where(may_have(f, ["k"], bits))) == [(0,), (1,), (2,)]


def test_rows_are_dropped_below_the_aggregate(spark):
    history = versions(spark, 20_000, 1, keys=5000)
    small = versions(spark, 50, 2, keys=5000).drop("current_row_ind")
    cur = open_versions(history, KEYS)
    assert reduce_by_keys(cur, small, KEYS).count() < 0.1 * cur.count()
    text = plan(classify_changes(small, history, KEYS, reduce=True))
    lines = [i for i, x in enumerate(text.splitlines()) if "getbit" in x]
    assert lines and "HashAggregate" in text or "SortAggregate" in text
    assert rows(classify_changes(small, history, KEYS, reduce=True)) == rows(classify_changes(small, history, KEYS))


# -- the step log --------------------------------------------------------------------------------

def steps(spark, broken=None):
    texts = {n: f"SELECT {n} AS n" for n in (10, 20, 30, 40)}
    if broken:
        texts[broken] = "SELECT n FROM nowhere_at_all"
    return spark.createDataFrame(
        [(" TRAC", "Work ", n, None, t, dt.date(2000, 1, 1), dt.date(9999, 12, 31)) for n, t in texts.items()]
        + [("TRAC", "WORK", 50, "later", "SELECT 1", dt.date(2002, 1, 1), dt.date(9999, 12, 31))],
        "source_cd string, work_table string, transformation_seq int, transformation_desc string, sql_statement string, "
        "valid_from date, valid_to date")


def test_resume_behind_the_last_success(spark, src):
    log, audit, seen = batch.log_table(spark), batch.audit_table(spark, src.batches), []
    work = scratch_table(spark, "work", SCHEMA)

    def execute(seq, result):
        assert result.first().n == seq
        seen.append(seq)
    args = ("trac", "WORK", AS_OF, log, "run1", execute, audit)
    with pytest.raises(batch.StepFailed, match="step 30"):
        batch.run_logged(spark, steps(spark, broken=30), *args)
    assert seen == [10, 20]
    assert batch.run_logged(spark, steps(spark), *args, analyze=work) == [30, 40] and seen == [10, 20, 30, 40]
    assert batch.run_logged(spark, steps(spark), *args) == []                      # nothing left to do
    got = spark.table(log).orderBy("transformation_seq", "attempt").collect()
    assert [(r.transformation_seq, r.attempt, r.status) for r in got] == [
        (10, 1, "S"), (20, 1, "S"), (30, 1, "F"), (30, 2, "S"), (40, 1, "S")]
    assert all(r.start_dtm <= r.end_dtm for r in got)
    assert [("nowhere_at_all" in (r.message or "")) for r in got] == [False, False, True, False, False]
    runs = spark.table(audit).where("batch_name = 'run1'").orderBy("audit_id").collect()
    assert [r.batch_load_stus_ind for r in runs] == ["F", "S", "S"] and all(r.batch_end_dtm for r in runs)
    assert table_statistics(spark, work)["row_count"] == 0


def test_failures_of_the_executor_are_logged_and_runs_do_not_mix(spark):
    log = batch.log_table(spark)

    def fail(seq, result):
        raise ZeroDivisionError("by hand")
    for attempt in (1, 2):
        with pytest.raises(batch.StepFailed):
            batch.run_logged(spark, steps(spark), "TRAC", "work", AS_OF, log, "a", fail)
    assert batch.run_logged(spark, steps(spark), "TRAC", "work", AS_OF, log, "b", lambda s, r: None) == [10, 20, 30, 40]
    got = rows(spark.table(log).where("run_id = 'a'").select("transformation_seq", "attempt", "status", "message"))
    assert got == [(10, 1, "F", "ZeroDivisionError: by hand"), (10, 2, "F", "ZeroDivisionError: by hand")]
    assert batch.run_logged(spark, steps(spark), "TRAC", "other", AS_OF, log, "b", fail) == []
