"""Plan checks: native expressions only, no cartesian products, lookups
broadcast, filters pushed into the parquet scan."""

import pytest

from conftest import SF_SMALL
from histloom import catalog

QUERIES = sorted(catalog.QUERIES)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_udf_no_cartesian(spark, name):
    p = plan_text(catalog.QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"


def test_translation_lookup_is_broadcast(spark):
    p = plan_text(catalog.QUERIES["translate_code"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def test_filters_and_columns_reach_scan(spark, tmp_path):
    from histloom.sources.fixtures import load_sources
    src = load_sources(spark, SF_SMALL)
    df = src.materialize(spark, str(tmp_path)).participant \
        .filter("actv_rcrd_ind = 'y'").select("icu_id")
    p = plan_text(df)
    assert "PushedFilters: [IsNotNull(actv_rcrd_ind), EqualTo(actv_rcrd_ind,y)]" in p
    assert "ReadSchema: struct<icu_id:string,actv_rcrd_ind:string>" in p


def test_current_row_flag_has_no_window(spark, src):
    """The flag is an aggregate joined back on the key: a hot key is combined
    map-side instead of being sorted in one window task."""
    from histloom.operators.history import mark_current
    from histloom.plans import party
    from histloom.plans.spec import prepared
    rows = prepared(party.LOAD_PARTY, src, "2001-01-01")
    p = plan_text(mark_current(rows, party.PARTY_KEY))
    assert "Window" not in p
    assert "SortAggregate" in p or "HashAggregate" in p


def test_latest_per_key_has_no_window(spark):
    p = plan_text(catalog.QUERIES["latest_per_key"](spark, SF_SMALL))
    assert "Window" not in p


def test_history_filter_reaches_the_scan(spark, src, tmp_path):
    """Closed versions of the target are not read."""
    from histloom.operators.history import classify_changes
    from histloom.plans import party
    from histloom.plans.spec import prepared, run_load
    run_load(party.LOAD_PARTY, src, as_of="2001-01-01").write.parquet(f"{tmp_path}/t")
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        p = plan_text(classify_changes(prepared(party.LOAD_PARTY, src, "2001-01-01"),
                                       spark.read.parquet(f"{tmp_path}/t"), party.PARTY_KEY))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "EqualTo(current_row_ind,true)" in p and "EqualTo(end_dt,9999-12-31)" in p


def test_hot_key_of_change_capture_is_split(spark):
    """Half of the source rows have one key: AQE splits its partition."""
    from pyspark.sql import functions as F
    from histloom.operators.history import classify_changes
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        ids = spark.range(0, 40_000, 1, 16)
        key = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        src = ids.select(key.alias("k"), F.md5(F.col("id").cast("string")).alias("check_sum"))
        target = ids.where("id % 3 = 0").select(
            key.alias("k"), F.lit("s").alias("check_sum"), F.lit(True).alias("current_row_ind"),
            F.lit("9999-12-31").cast("date").alias("end_dt"), F.col("id").cast("int").alias("audit_id"))
        out = classify_changes(src, target, ["k"])
        assert len(out.collect()) == 40_000
        assert "skew=true" in plan_text(out)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_duplicate_translations_are_found(spark):
    from histloom.operators.lookup import duplicate_translations
    t = spark.createDataFrame([("A", " x ", "1"), ("A", "X", "2"), ("A", "y", "1"), ("B", "y", "3")],
                              "src_cde string, src_fld_val string, trnslt_fld_val string")
    assert [(r.key, r.n) for r in duplicate_translations(t, {"src_cde": "A"}).collect()] == [("X", 2)]
