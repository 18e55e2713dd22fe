"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing,
pieces.  Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as parquet and read again as the next one's docs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from histloom.llm import merge_dropout, mixing, near_duplicates, pii, quality_rules
from histloom.llm.common import table
from histloom.sources.io import scratch_path

#: Classifier, risk bounds, components and fitted rates are beyond SQL; the
#: pipeline is tested against a brute-force version.
ORACLE_SQL = None


#: Hundredths of similarity from which documents count as copies.
COPIES = 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_documents(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (from ``COPIES`` up) stays."""
    return near_duplicates.drop_near_duplicates(docs, COPIES)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated so that low and toxic text keeps half
    of its tokens and good text takes the rest."""
    return mixing.resample_documents(docs, mixing.quality_domains(table(spark, sf_dir, "labels")),
                                     factors=mixing.FACTORS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, with seeded merge-dropout; the copies that mixing
    made lie side by side and are segmented each in its own way."""
    return merge_dropout.encode_documents(docs, copies=True)


STAGES = [("quality_rules", keep_good), ("near_duplicates", drop_copies), ("personal_data", redact),
          ("mixing", mix), ("pieces", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
