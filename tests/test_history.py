import datetime as dt

from pyspark.sql import functions as F

from histloom.operators.history import (classify_changes, effective_target, fan_out, keep_changes,
                                        latest_per_key, mark_current, reflag_current, restart_begin_on_update)

OPEN = dt.date(9999, 12, 31)
SCHEMA = ("k string, check_sum string, begin_dt date, begin_dtm timestamp_ntz, end_dt date, "
          "end_dtm timestamp_ntz, current_row_ind boolean, a string")


def _rows(spark, rows):
    out = []
    for k, cs, b, e, cur, a in rows:
        out.append((k, cs, b, dt.datetime.combine(b, dt.time()) if b else None, e,
                    dt.datetime.combine(e, dt.time()) if e else None, cur, a))
    return spark.createDataFrame(out, SCHEMA)


def test_classify_insert_update_duplicate_and_null_checksum(spark):
    d = dt.date(2000, 1, 1)
    target = _rows(spark, [("k1", "s1", d, OPEN, True, "x"), ("k2", "s2", d, OPEN, True, "x"),
                           ("k3", None, d, OPEN, True, "x"), ("k4", "s4", d, dt.date(2000, 6, 1), True, "x"),
                           ("k5", "s5", d, OPEN, False, "x")])
    src = _rows(spark, [("k1", "s1", d, OPEN, None, "y"), ("k2", "zz", d, OPEN, None, "y"),
                        ("k3", "s3", d, OPEN, None, "y"), ("k4", "s4", d, OPEN, None, "y"),
                        ("k5", "s5", d, OPEN, None, "y"), ("k6", "s6", d, OPEN, None, "y")]).drop("current_row_ind")
    got = dict(classify_changes(src, target, ["k"]).select("k", "change_type").collect())
    # closed (k4) and non-current (k5) target rows do not count; NULL checksum compares as 'D'
    assert got == {"k1": "D", "k2": "U", "k3": "D", "k4": "I", "k5": "I", "k6": "I"}


def test_classify_compares_latest_current_row_only(spark):
    d1, d2 = dt.date(2000, 1, 1), dt.date(2001, 1, 1)
    target = _rows(spark, [("k", "old", d1, OPEN, True, "x"), ("k", "new", d2, OPEN, True, "x")])
    src = _rows(spark, [("k", "new", d2, OPEN, None, "y")]).drop("current_row_ind")
    got = classify_changes(src, target, ["k"]).collect()
    assert len(got) == 1 and got[0].change_type == "D"


def _stored(spark, rows):
    """Rows of (key, checksum, begin, audit id, load time), all current and open."""
    df = _rows(spark, [(k, cs, b, OPEN, True, "x") for k, cs, b, _, _ in rows])
    loads = spark.createDataFrame([(k, cs, b, a, t) for k, cs, b, a, t in rows],
                                  "k string, check_sum string, begin_dt date, audit_id int, row_process_dtm timestamp_ntz")
    return df.join(loads, ["k", "check_sum", "begin_dt"]).withColumn("source_system_id", F.lit("203"))


def test_classify_compares_the_version_loaded_last(spark):
    d, t1, t2 = dt.date(2000, 1, 1), dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)
    # same begin date; the older load has the larger checksum
    target = _stored(spark, [("k", "zzz", d, 1, t1), ("k", "aaa", d, 1, t2), ("j", "aaa", d, 1, t2), ("j", "zzz", d, 2, t1)])
    src = _rows(spark, [("k", "aaa", d, OPEN, None, "y"), ("j", "zzz", d, OPEN, None, "y")]).drop("current_row_ind")
    got = {r.k: r.change_type for r in classify_changes(src, target, ["k"]).collect()}
    assert got == {"k": "D", "j": "D"}


def test_effective_target_keeps_what_ranks_versions(spark):
    d1, d2, t = dt.date(2000, 1, 1), dt.date(2005, 1, 1), dt.datetime(2001, 1, 1)
    target = _stored(spark, [("k", "zzz", d1, 1, t), ("k", "aaa", d2, 1, t)])
    src = _rows(spark, [("k", "aaa", d2, OPEN, None, "y")]).drop("current_row_ind")
    direct = classify_changes(src, target, ["k"]).first().change_type
    through = classify_changes(src, effective_target(target, None, ["k"]), ["k"]).first().change_type
    assert direct == through == "D"


def test_reflag_leaves_one_current_version(spark):
    d, t1, t2 = dt.date(2000, 1, 1), dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)
    both = _stored(spark, [("k", "zzz", d, 1, t1), ("k", "aaa", d, 1, t2), ("j", "s", d, 1, t1)])
    got = {(r.k, r.check_sum): r.current_row_ind for r in reflag_current(both, ["k"]).collect()}
    assert got == {("k", "zzz"): False, ("k", "aaa"): True, ("j", "s"): True}


def test_mark_current_one_open_latest_row_per_key(spark):
    d = dt.date(2000, 1, 1)
    df = _rows(spark, [("k", "a", d, OPEN, None, "1"), ("k", "b", dt.date(2000, 2, 1), OPEN, None, "2"),
                       ("k", "c", d, dt.date(2000, 5, 1), None, "3"),
                       ("j", "a", d, dt.date(2000, 5, 1), None, "4"),
                       (None, "a", d, OPEN, None, "5"), (None, "b", d, OPEN, None, "6")]).drop("current_row_ind")
    got = {r.a: r.current_row_ind for r in mark_current(df, ["k"]).collect()}
    # k: both open, later begin wins; j: only version is closed; NULL keys form one group
    assert got == {"1": False, "2": True, "3": False, "4": False, "5": False, "6": True}


def test_mark_current_full_ties_are_deterministic(spark):
    d = dt.date(2000, 1, 1)
    df = _rows(spark, [("k", "s", d, OPEN, None, str(i)) for i in range(20)]).drop("current_row_ind")
    got = [r.a for r in mark_current(df.repartition(7), ["k"]).filter("current_row_ind").collect()]
    assert got == ["9"]  # remaining columns break the tie, descending


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, dt.date(2000, 1, 1), "x"), ("a", 2, dt.date(2000, 1, 1), "y"),
                                ("a", 9, dt.date(1999, 1, 1), "z"), ("b", 1, None, "w")],
                               "k string, n int, d date, v string")
    got = {r.k: r.v for r in latest_per_key(df, ["k"], ["d", "n"]).collect()}
    assert got == {"a": "y", "b": "w"}


def test_restart_begin_on_update(spark):
    d = dt.date(2000, 1, 1)
    df = _rows(spark, [("k", "s", d, OPEN, None, "1")]).withColumn("change_type", F.lit("U"))
    r = restart_begin_on_update(df, "2001-01-01").collect()[0]
    assert r.begin_dt == dt.date(2001, 1, 1) and r.begin_dtm == dt.datetime(2001, 1, 1)


def test_effective_target_drops_superseded_dimension_rows(spark):
    d = dt.date(2000, 1, 1)
    dim = _rows(spark, [("k1", "s1", d, OPEN, True, "x"), ("k2", "s2", d, OPEN, True, "x")]) \
        .withColumn("source_system_id", F.lit("203"))
    work = _rows(spark, [("k1", "zz", d, OPEN, True, "y"), ("k2", "s2", d, OPEN, True, "y")]) \
        .withColumn("source_system_id", F.lit("203"))
    got = sorted((r.k, r.check_sum) for r in effective_target(dim, work, ["k"]).collect())
    assert got == [("k1", "zz"), ("k2", "s2")]


def test_keep_changes(spark):
    df = spark.createDataFrame([("I",), ("U",), ("D",)], "change_type string")
    assert sorted(r.change_type for r in keep_changes(df).collect()) == ["I", "U"]


def test_fan_out_emits_the_variants_that_hold(spark):
    df = spark.createDataFrame([(1, "c", "t"), (2, None, "t"), (3, None, None)], "id int, c string, t string")
    got = fan_out(df, [(F.col("c").isNotNull(), {"v": F.col("c"), "kind": F.lit("C")}),
                       (F.col("t") == "t", {"v": F.col("t"), "kind": F.lit("T")})])
    assert got.columns == ["id", "c", "t", "v", "kind"]
    assert sorted((r.id, r.v, r.kind) for r in got.collect()) == [(1, "c", "C"), (1, "t", "T"), (2, "t", "T")]
