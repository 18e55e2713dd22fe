"""The stages one after the other against plain versions of their decisions."""

import corpus_pipeline as cp
from histloom.llm import mixing, pii

from . import cases
from .test_thresholds import survivors

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _write(spark, tmp_path):
    base = str(tmp_path)
    cases.docs(spark).select(*COLUMNS).write.parquet(f"{base}/documents.parquet")
    cases.labels(spark).write.parquet(f"{base}/labels.parquet")
    return base


def test_stages(spark, tmp_path):
    base = _write(spark, tmp_path)
    docs = spark.read.parquet(f"{base}/documents.parquet")
    stages = dict(cp.STAGES)
    assert len(cp.STAGES) == 5
    whole = [tuple(r) for r in docs.collect()]

    kept = [tuple(r) for r in cp.keep_good(spark, docs, base).collect()]
    from .test_texts import counts
    assert sorted(kept, key=str) == sorted((r for r in whole if not counts(r[1])[5]), key=str)  # no cutoff certified

    single = stages["near_duplicates"](spark, docs, base)
    assert single.columns == COLUMNS
    assert sorted(str(r.doc_id) for r in single.collect()) == survivors(whole, cp.COPIES)

    anchors = pii.build_anchors()
    clean = sorted((tuple(r)[:2] for r in cp.redact(spark, docs, base).collect()), key=str)
    assert clean == sorted(((r[0], r[1] and pii.redact(r[1], pii.find_spans(r[1], anchors))) for r in whole), key=str)

    mixed = cp.mix(spark, docs, base)
    assert mixed.columns == COLUMNS
    copies = mixing.mix_documents(docs, mixing.quality_domains(cases.labels(spark)), factors=mixing.FACTORS)
    assert mixed.count() == sum(r.copies for r in copies.collect())

    assert cp.encode(spark, docs, base).where("NOT lossless").count() == 0


def test_run(spark, tmp_path):
    base = _write(spark, tmp_path)
    got = cp.run(spark, base)
    assert got.columns == ["doc_id", "variant", "n_tokens", "ids", "lossless"] and got.count() > 0


def test_empty_documents(spark, tmp_path):
    base = _write(spark, tmp_path)
    docs = spark.read.parquet(f"{base}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        assert stage(spark, docs, base).count() == 0, name
