"""DISTINCT and the current-row flag of stored rows: equal to the plain operators on odd
keys, ties and repeats, and without moving whole rows."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from histloom.operators import history
from histloom.operators.history import distinct_stored, mark_current, mark_current_stored

SCHEMA = "k string, k2 string, check_sum string, begin_dt date, end_dt date, audit_id int, a string"


def _rows(spark, path, seed=5, n=4000, keys=300):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        k = "hot" if i % 5 == 0 else rnd.choice([None, f"k{rnd.randint(0, keys)}"] + [f"u{i}"] * 3)
        rows.append((k, rnd.choice([None, "x", "hot"]), rnd.choice(["a", "b", None]),
                     rnd.choice([None, "1995-01-01", "1995-01-02"]),
                     rnd.choice(["9999-12-31", "9999-12-31", "2000-01-01", None]), rnd.randint(1, 3), f"v{i % 3500}"))
    rows += rows[:200]
    df = spark.createDataFrame(rows, SCHEMA.replace("date", "string")).withColumns(
        {c: F.col(c).cast("date") for c in ("begin_dt", "end_dt")})
    df.repartition(6).write.parquet(path)
    return spark.read.parquet(path)


def _sorted(df):
    return sorted(map(str, df.collect()))


def test_flag_of_stored_rows_equals_mark_current(spark, tmp_path):
    df = _rows(spark, f"{tmp_path}/t")
    for keys in (["k"], ["k", "k2"]):
        for order in (history.VERSION_ORDER, ("audit_id", *history.VERSION_ORDER), ("check_sum",)):
            want = mark_current(df, keys, order)
            assert _sorted(mark_current_stored(df, keys, order).select(*want.columns)) == _sorted(want)


@pytest.mark.parametrize("few", [history.FEW, 1], ids=["few", "many"])
def test_distinct_of_stored_rows(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(history, "FEW", few)
    df = _rows(spark, f"{tmp_path}/t")
    assert _sorted(distinct_stored(df)) == _sorted(df.distinct())
    once = df.distinct()
    once.write.parquet(f"{tmp_path}/once")
    assert _sorted(distinct_stored(spark.read.parquet(f"{tmp_path}/once"))) == _sorted(once)
    nothing = df.where("audit_id > 9")
    assert distinct_stored(nothing).count() == 0 and mark_current_stored(nothing, ["k"]).count() == 0


def test_account_load_does_not_move_stored_rows(spark):
    """No key has two versions: the flag needs no exchange of whole rows."""
    from histloom import catalog
    df = catalog.QUERIES["load_account"](spark, SF_SMALL)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == df.distinct().count()
