"""Loads against the DuckDB oracle at sf0.001, and history properties."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows_as_text
from histloom import catalog
from histloom.plans import account, address, agreement, contact, party, xref
from histloom.plans.spec import run_loads
from histloom.sources.io import checkpoint_dir, cut_lineage, release_cuts
from oracle.catalog import ORACLES

AS_OF = "2001-01-01"
ORACLE_KEYS = sorted(k for k in catalog.QUERIES if k in ORACLES)


@pytest.mark.parametrize("name", ORACLE_KEYS)
def test_query_matches_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    got = df.collect()
    cur = duck.execute(ORACLES[name]())
    want = cur.fetchall()
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_as_text(got, df.columns) == rows_as_text(want, cols)


SPECS = {
    "party": ([party.LOAD_PARTY], party.PARTY_KEY),
    "account": ([account.LOAD_ACCOUNT], account.ACCOUNT_KEY),
    "address": (address.ADDRESS_LOADS, address.ADDRESS_KEY),
    "agreement": (agreement.AGREEMENT_LOADS, agreement.AGREEMENT_KEY),
    "xref": ([r[0] for r in xref.XREF_ROUNDS], xref.XREF_KEY),
    "phone": ([contact.LOAD_PARTY_PHONE], contact.PARTY_PHONE_KEY),
}


@pytest.mark.parametrize("name", sorted(SPECS))
def test_at_most_one_current_row_per_key(spark, src, name):
    specs, keys = SPECS[name]
    out = run_loads(specs, src)
    worst = out.filter("current_row_ind").groupBy(*keys).count().agg(F.max("count")).collect()[0][0]
    assert worst in (None, 1)


@pytest.mark.parametrize("name", ["party", "address", "phone"])
def test_reload_against_own_output(spark, src, name):
    """A reload adds no current version.  Keys that only have closed versions
    have nothing to compare with: exactly their rows come again, as inserts, on
    each run."""
    specs, keys = SPECS[name]
    first = cut_lineage(run_loads(specs, src, as_of=AS_OF))
    closed = first.join(first.filter("end_dt = DATE'9999-12-31'").select(*keys).distinct(), list(keys), "left_anti")
    again = cut_lineage(run_loads(specs, src, history=first, as_of=AS_OF))
    assert again.filter("current_row_ind").count() == 0
    if len(specs) == 1:
        assert again.count() == closed.count()
        third = run_loads(specs, src, history=first.unionByName(again), as_of=AS_OF)
        assert third.count() == closed.count()


def test_unchanged_third_batch_updates_nothing(spark):
    for name in ("load_party_incremental", "load_account_incremental", "load_agreement_incremental",
                 "load_address_incremental"):
        out = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        current = {r.batch_no: r["count"] for r in out.filter("current_row_ind").groupBy("batch_no").count().collect()}
        assert current.get(2, 0) > 0 and 3 not in current, (name, current)


def test_account_update_starts_at_the_processing_date(spark):
    out = catalog.QUERIES["load_account_incremental"](spark, "/root/testdata/sf0.001")
    starts = {str(r.begin_dt) for r in out.filter("batch_no = 2").select("begin_dt").distinct().collect()}
    assert starts == {AS_OF}


def test_cross_reference_loads_take_three_cuts(spark):
    release_cuts(spark)
    catalog.QUERIES["load_party_xref_all"](spark, SF_SMALL)
    assert release_cuts(spark) == 3


def test_cuts_are_released(spark, src):
    run_loads([party.LOAD_PARTY], src, as_of=AS_OF).collect()
    assert release_cuts(spark) > 0
    base = checkpoint_dir(spark).removeprefix("file:")
    assert not [x for x in os.listdir(base) if x.startswith("cut-")]


def test_changed_attribute_becomes_update(spark, src):
    from histloom.plans.spec import prepared, run_load
    from histloom.operators.history import classify_changes
    spec = party.LOAD_PARTY
    first = run_load(spec, src, as_of=AS_OF)
    renamed = src.sponsor.withColumn("spnsr_cmpny_nm", F.when(F.col("spnsr_cmpny_key") == 1, F.lit("NEW NAME"))
                                     .otherwise(F.col("spnsr_cmpny_nm")))
    from histloom.sources.fixtures import Sources
    src2 = Sources({**src.frames, "src_sponsor": renamed})
    c = classify_changes(prepared(spec, src2, "2001-01-01"), first, spec.keys)
    kinds = {r.change_type for r in c.filter(F.col("full_nm") == "NEW NAME").collect()}
    assert kinds == {"U"}
    # unchanged rows of keys with a current version are duplicates; closed-only
    # keys have nothing current to compare with and come back as inserts
    cur = first.filter("current_row_ind").select(*spec.keys)
    same = c.filter(F.col("full_nm") != "NEW NAME").join(cur, list(spec.keys), "left_semi")
    assert same.filter("change_type <> 'D'").count() == 0
    assert same.count() > 0


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0
    assert "dim_account_natural_key_hash_uuid" in df.columns
