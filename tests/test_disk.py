"""What a load leaves on disk: shuffle files go with the job that stores rows, stored rows go
once nothing reads them, and rows that are all new, changed or known do not move."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from histloom import catalog
from histloom.operators import history
from histloom.operators.history import classify_changes, classify_stored, keys_occur_once
from histloom.sources import fixtures
from histloom.sources.io import cut_lineage, cuts_made, release_cuts


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (blocks.apply(i).getName() for i in range(blocks.size())) if f.startswith("shuffle_")}


def test_shuffle_files_go_with_the_job_that_stores_rows(spark):
    before = _shuffle_files(spark)
    df = cut_lineage(spark.range(20000).repartition(8, "id").groupBy((F.col("id") % 900).alias("k")).count())
    assert df.count() == 900 and all(".zstd." in f for f in df.inputFiles())
    assert not {f for f in _shuffle_files(spark) - before if f.endswith(".data")} or _cleared(spark, before)


def _cleared(spark, before):
    """Block managers delete in the background; the count above has a small shuffle of its own."""
    import time
    for _ in range(40):
        if len({f.split("_")[1] for f in _shuffle_files(spark) - before}) <= 1:
            return True
        time.sleep(0.25)
    return False


@pytest.mark.parametrize("name", ["load_account", "load_party_agreement_all", "load_address_all",
                                  "load_party_address_all", "load_party_xref_all"])
def test_only_what_the_result_reads_stays(spark, name):
    release_cuts(spark)
    out = catalog.QUERIES[name](spark, SF_SMALL)
    folders = {f.rsplit("/", 2)[-2] for f in out.inputFiles()}
    assert len(folders) == cuts_made() <= 3
    release_cuts(spark)


def test_appended_addresses_leave_no_copies(spark):
    release_cuts(spark)
    n = catalog.QUERIES["append_by_name"](spark, SF_SMALL).count()
    assert n and cuts_made() == 0


def test_cuts_of_others_stay(spark):
    release_cuts(spark)
    own = cut_lineage(spark.range(3))
    made = cuts_made()
    kept, gone = cut_lineage(spark.range(4)), cut_lineage(spark.range(5))
    assert release_cuts(spark, made, kept) == 1 and cuts_made() == 2
    assert own.count() == 3 and kept.count() == 4
    with pytest.raises(Exception, match="(?i)not.exist"):
        gone.count()
    assert release_cuts(spark) == 2


def test_participants_are_derived_once(spark):
    release_cuts(spark)
    plain = fixtures.load_sources(spark, SF_SMALL)
    src = fixtures.load_sources(spark, SF_SMALL, fixtures.PEOPLE)
    assert cuts_made() == 2 and fixtures.load_sources(spark, SF_SMALL) is plain
    for name in ("participant", "beneficiary", "employee"):
        own = getattr(src, name)
        assert all("/cut-" in f for f in own.inputFiles())
        want = getattr(plain, name)
        assert own.schema.names == want.schema.names
        assert own.exceptAll(want).isEmpty() and want.exceptAll(own).isEmpty()
    assert src.xref.exceptAll(plain.xref).isEmpty() and plain.xref.exceptAll(src.xref).isEmpty()
    release_cuts(spark)


def test_keys_that_occur_once(spark):
    schema = "k string, k2 string"
    once = [("a", None), (None, "a"), ("", "a"), ("a", ""), (None, None), ("a", "a")]
    assert keys_occur_once(spark.createDataFrame(once, schema), ["k", "k2"])
    assert not keys_occur_once(spark.createDataFrame([*once, (None, None)], schema), ["k", "k2"])
    assert not keys_occur_once(spark.createDataFrame(once, schema), ["k"])
    assert keys_occur_once(spark.createDataFrame([], schema), ["k"])


def _history(spark, rows):
    df = spark.createDataFrame(rows, "k string, check_sum string, begin string, end string, audit_id int, current_row_ind boolean")
    return df.select("k", "check_sum", F.col("begin").cast("date").alias("begin_dt"), F.col("begin").cast("timestamp_ntz").alias("begin_dtm"),
                     F.col("end").cast("date").alias("end_dt"), F.col("end").cast("timestamp_ntz").alias("end_dtm"), "audit_id", "current_row_ind")


@pytest.mark.parametrize("few", [history.FEW, 1], ids=["few", "many"])
def test_changes_of_stored_rows(spark, monkeypatch, few):
    """NULL keys and checksums, several versions of a key, repeated rows, closed ones."""
    monkeypatch.setattr(history, "FEW", few)
    rnd, open_end = random.Random(3), "9999-12-31"
    target = _history(spark, [(rnd.choice([None, *(f"k{i}" for i in range(60))]), rnd.choice(["a", "b", None]),
                               rnd.choice(["1995-01-01", "1996-01-01", None]), rnd.choice([open_end, open_end, "2000-01-01"]),
                               rnd.randint(1, 3), rnd.random() < 0.8) for _ in range(200)])
    rows = [(rnd.choice([None, *(f"k{i}" for i in range(90))]), rnd.choice(["a", "b", None]),
             "1995-01-01", open_end, 4, True) for _ in range(400)]
    rows = cut_lineage(_history(spark, rows + rows[:40]).drop("current_row_ind"))
    want = classify_changes(rows, target, ["k"])
    got, joined = classify_stored(rows, target, ["k"])
    assert joined and sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("kind", ["I", "U", "D"])
def test_rows_that_are_all_alike_do_not_move(spark, kind):
    rows = [(f"k{i}", "a", "1995-01-01", "9999-12-31", 2, True) for i in range(50)]
    target = _history(spark, [(f"x{k}" if kind == "I" else k, "b" if kind == "U" else s, *rest) for k, s, *rest in rows])
    got, joined = classify_stored(cut_lineage(_history(spark, rows)), target, ["k"])
    assert not joined and "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert [(r.change_type, r["count"]) for r in got.groupBy("change_type").count().collect()] == [(kind, 50)]
    assert classify_stored(cut_lineage(_history(spark, rows).limit(0)), target, ["k"])[0].count() == 0
