"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words (space, tab to CR).
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scalar(df: DataFrame, agg: Column):
    """One aggregated value of ``df``."""
    return df.agg(agg.alias("v")).first()["v"]


def map_texts(df: DataFrame, columns: list[str], schema: str,
              make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]]) -> DataFrame:
    """Run a batch function over ``columns`` of ``df`` (nothing else is read).

    ``make`` is called once per task and returns the batch function, so state
    such as a cache lives for one task; batches come and go one at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                out = step(batch)
                if out is not None:
                    yield out
    return df.select(*columns).mapInArrow(run, schema)


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct named _row, so that helper columns
    beside it cannot clash with any of them; ``select("_row.*")`` unpacks it."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
