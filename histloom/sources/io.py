"""Session setup, lineage cuts and sinks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Frees the shuffle files of an SQL execution at its end (Spark 4.1).  Else they stay until the
#: driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(master: str = "local[8]", shuffle_partitions: int = 8,
            app: str = "histloom") -> SparkSession:
    """A session for tests, the bench and the entry point.  On a cluster, get
    the cluster's session instead and keep its settings."""
    return (SparkSession.builder.master(master).appName(app)
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", "16g")
            .getOrCreate())


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir`` of the cluster.
    Only a local session without one gets a fresh scratch folder."""
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
    elif sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="histloom-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
    return sc.getCheckpointDir()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds inside."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    (survives executor loss) and continue from the stored copy.

    One job computes and writes the rows.  (An eager reliable ``checkpoint()``
    of a non-persisted DataFrame computes it twice: once for the count, once
    more to write the checkpoint files.)  zstd about halves the texts of hashes; the
    job's shuffle files are freed at its end."""
    spark = df.sparkSession
    path = scratch_path(spark, f"cut-{uuid.uuid4().hex}")
    _cuts.append(path)
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


_cuts: list[str] = []


def cuts_made() -> int:
    """How many cuts are stored; ``release_cuts`` takes it as ``since``."""
    return len(_cuts)


def release_cuts(spark: SparkSession, since: int = 0, but: DataFrame | None = None) -> int:
    """Delete the stored copies of this process's lineage cuts (``since``: those made after
    so many); returns how many.  Call it once a run's results are written: frames that read
    a cut end with it.  Those that ``but`` reads stay."""
    jvm = spark.sparkContext._jvm
    read = {f.rsplit("/", 2)[-2] for f in but.inputFiles()} if but is not None else set()
    gone = [c for c in _cuts[since:] if c.rsplit("/", 1)[-1] not in read]
    for c in gone:
        path = jvm.org.apache.hadoop.fs.Path(c)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _cuts.remove(c)
    return len(gone)


def refresh_statistics(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Statistics of a catalog table, and of ``columns`` if given."""
    of = f" FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{of}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def overwrite(df: DataFrame, path: str) -> None:
    """Truncate-and-reload sink."""
    df.write.mode("overwrite").parquet(path)
