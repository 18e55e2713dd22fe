import datetime as dt

import pytest
from pyspark.sql import functions as F

from histloom.operators import control


def test_audit_open_appends_next_id(spark, src):
    b = src.batches
    out = control.audit_open(b, "batch_x", "cron", "I", "2001-01-01 00:00:00")
    assert out.count() == b.count() + 1
    new = out.filter(F.col("batch_name") == "batch_x").collect()
    assert len(new) == 1 and new[0].batch_end_dtm is None
    assert new[0].audit_id == b.agg(F.max("audit_id")).collect()[0][0] + 1


def test_audit_close_updates_latest_open_row_only(spark, src):
    b = src.batches
    open_ids = [r.audit_id for r in b.filter("batch_end_dtm IS NULL AND batch_name = 'batch_2'").collect()]
    out = control.audit_close(b, "batch_2", "S", "2001-01-01 00:00:00")
    changed = out.subtract(b).collect()
    assert [r.audit_id for r in changed] == [max(open_ids)]
    assert changed[0].batch_end_dtm == dt.datetime(2001, 1, 1)


def test_steps_count_valid_and_single(spark, src):
    s = src.steps
    total = control.step_count(s, " trac", "dim_party").collect()[0].step_count
    valid = control.valid_steps(s, "TRAC", "DIM_PARTY", "2001-01-01").orderBy("step_index").collect()
    assert 0 < len(valid) <= total
    assert [r.step_index for r in valid] == list(range(1, len(valid) + 1))
    assert all("\n" not in r.sql_statement and "\t" not in r.sql_statement for r in valid)


def test_run_steps_executes_in_order(spark, src):
    spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").createOrReplaceTempView("supplier")
    res = control.run_steps(spark, src.steps, "TRAC", "DIM_PARTY", "2001-01-01")
    seqs = [int(s) for s, _ in res]
    assert seqs == sorted(seqs) and len(seqs) > 0
    nation = {r.s_suppkey: r.s_nationkey for r in spark.table("supplier").collect()}
    for seq, df in res:                        # each step counts the suppliers of its own one's nation
        assert df.collect()[0].n == sum(n == nation[int(seq)] for n in nation.values())


def test_single_step_missing_raises(spark, src):
    with pytest.raises(LookupError):
        control.run_steps(spark, src.steps, "TRAC", "DIM_PARTY", "2001-01-01", seq=-5)
