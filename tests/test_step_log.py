"""Log rows of a step run are stored while the next steps run."""

import time

import pytest

from histloom.operators import batch


def test_log_of_steps_is_grouped(spark, monkeypatch):
    """Rows that come while an INSERT runs go into the next one together, in order."""
    log, sizes = batch.log_table(spark), []
    plain = batch._LogWriter._insert

    def slow(self, rows):
        sizes.append(len(rows))
        time.sleep(0.5)
        plain(self, rows)
    monkeypatch.setattr(batch._LogWriter, "_insert", slow)
    steps = spark.sql("select 'trac' source_cd, 'w' work_table, cast(id as int) transformation_seq, cast(null as string) "
                      "transformation_desc, concat('select ', id, ' as n') sql_statement, date '2000-01-01' valid_from, "
                      "date '9999-12-31' valid_to from range(1, 13)")
    assert batch.run_logged(spark, steps, "trac", "w", "2001-01-01", log, "r", lambda seq, df: f"it's {seq}") == list(range(1, 13))
    rows = spark.table(log).orderBy("transformation_seq").collect()
    assert [(r.transformation_seq, r.attempt, r.status, r.message) for r in rows] == [
        (i, 1, "S", f"it's {i}") for i in range(1, 13)]
    assert all(r.start_dtm <= r.end_dtm for r in rows)
    assert sum(sizes) == 12 and len(sizes) < 12


def test_a_failed_insert_into_the_log_ends_the_run(spark, monkeypatch):
    steps = spark.sql("select 'trac' source_cd, 'w' work_table, 1 transformation_seq, cast(null as string) "
                      "transformation_desc, 'select 1 as n' sql_statement, date '2000-01-01' valid_from, "
                      "date '9999-12-31' valid_to")

    def broken(self, rows):
        raise OSError("disk")
    monkeypatch.setattr(batch._LogWriter, "_insert", broken)
    with pytest.raises(OSError, match="disk"):
        batch.run_logged(spark, steps, "trac", "w", "2001-01-01", batch.log_table(spark), "r", lambda seq, df: "x")


def _steps(spark, n):
    return spark.sql("select 'trac' source_cd, 'w' work_table, cast(id as int) transformation_seq, cast(null as string) "
                     "transformation_desc, concat('select ', id, ' as n') sql_statement, date '2000-01-01' valid_from, "
                     f"date '9999-12-31' valid_to from range(1, {n + 1})")


def test_steps_run_side_by_side_and_are_logged_in_order(spark):
    """Up to ``ahead`` steps at a time; what began behind a failed step is not logged and runs again."""
    log, now, most, seen = batch.log_table(spark), [0], [0], []

    def execute(seq, df):
        now[0] += 1
        most[0] = max(most[0], now[0])
        time.sleep(0.02 * (seq % 3))
        now[0] -= 1
        seen.append(seq)
        if seq == 7 and seen.count(7) == 1:
            raise ValueError("broken")
        return str(df.first().n)

    args = ("trac", "w", "2001-01-01", log, "r", execute)
    with pytest.raises(batch.StepFailed, match="step 7"):
        batch.run_logged(spark, _steps(spark, 12), *args, ahead=4)
    assert sorted(seen)[:7] == list(range(1, 8)) and max(seen) <= 10
    assert batch.run_logged(spark, _steps(spark, 12), *args, ahead=4) == list(range(7, 13))
    assert 1 < most[0] <= 4
    rows = spark.table(log).orderBy("transformation_seq", "attempt").collect()
    assert [(r.transformation_seq, r.attempt, r.status) for r in rows] == [
        *[(i, 1, "S") for i in range(1, 7)], (7, 1, "F"), (7, 2, "S"), *[(i, 1, "S") for i in range(8, 13)]]


def test_a_step_waits_for_the_one_before(spark):
    order = []

    def execute(seq, df):
        order.append(seq)
        time.sleep(0.05)
        order.append(-seq)
    batch.run_logged(spark, _steps(spark, 4), "trac", "w", "2001-01-01", batch.log_table(spark), "r", execute)
    assert order == [1, -1, 2, -2, 3, -3, 4, -4]
