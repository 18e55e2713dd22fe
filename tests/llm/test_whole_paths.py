"""The path of a stratum is ordered on a fifth of all its labelled documents."""

from pyspark.sql import functions as F

from histloom.llm import quality_rules as q


def test_path_share_has_no_bound_in_rows(spark):
    n = 150_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"),
                                 F.array(*[(F.col("id") % 10).cast("int")] * len(q.RULES)).alias("_q_levels"))
    labels = docs.select("doc_id", (F.col("doc_id") % 10 < 7).cast("int").alias("quality"))
    drawn = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) / 1_000_000 < q.PATH_SHARE)
    assert drawn.count() > 25_000
    # good documents have levels 0 to 6, low ones 7 to 9
    cuts = {r.stratum: r._q_cuts for r in q.fit_cutoffs(docs, labels).collect()}
    assert set(cuts) == {"en"} and min(cuts["en"]) == 6
    assert q.PATH_ROWS >= n and q.PATH_SHARE == 0.2
