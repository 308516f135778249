"""Session helpers: the shared working folder, the size check before a broadcast, the local session of tests and bench."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
"""Largest row count a side may have to be broadcast."""
BROADCAST_BYTES = 64 << 20
"""Largest size of such a side, as the length of its rows as JSON."""

BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
"""Spark's bound on an Arrow batch and its value where texts go to Python: executor and worker hold batches twice."""

_WRITTEN: list[str] = []
"""Paths in the shared folder that this process has given out."""


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediates that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and executors are one
    process, falls back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="offerforge-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    _WRITTEN.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def drop_written(spark: SparkSession) -> int:
    """Removes what this process has put under ``scratch_path`` and returns the number of paths.

    For the end of a job: DataFrames that still read these tables can no longer be evaluated.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while _WRITTEN:
        path = hadoop.Path(_WRITTEN.pop())
        dropped += bool(path.getFileSystem(conf).delete(path, True))
    return dropped


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as columns to the shared folder and read back: several passes over it cost one evaluation.

    It also cuts the lineage, and the copy outlives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "written")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of about ``BATCH_BYTES`` in what runs meanwhile; the session's own bound is put back."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of ``max_bytes`` in all; reads no more than one row past the bound."""
    size = F.octet_length(F.to_json(F.struct("*"))) if df.columns else F.lit(0)
    rows, total = df.limit(max_rows + 1).select(size.alias("_size")).agg(F.count("*"), F.sum("_size")).first()
    return rows <= max_rows and (total or 0) <= max_bytes


def local_session(cores: int | str = "*", app: str = "offerforge", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the launcher configures the session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
