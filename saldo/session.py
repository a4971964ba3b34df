"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where that costs the parent one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "saldo", master: str | None = None, **extra: str) -> SparkSession:
    """Build a session; sizes (shuffle partitions, memory) are left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``, or one in the warehouse where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of a table as they are now, kept in the shared folder and dropped with their last reader's context."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


# Whether the shuffle files of a statement go when it ends.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within the block the shuffle files of a write or an action are removed when it has ended.

    Otherwise they stay until the driver collects its garbage, so that a query of several writes holds the shuffles of
    all of them on disk. Who runs one DataFrame twice in the block has its shuffles made twice; written and
    checkpointed tables have none.
    """
    former = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLES_GO, former)


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A new folder below the shared one, removed with all it holds at the end of the block."""
    folder = f"{shared_dir(spark)}/saldo-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
