"""Shared folder, scratch tables, document columns and packed exchanges."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Matches the contract's white space: space and the controls 09 to 0D.
WHITE = "[\\x20\\x09-\\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a session on one machine uses a folder of its warehouse; a cluster is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


#: Folders and tables that this driver's queries have written to the shared folder.
_SCRATCH_FOLDERS: list[str] = []
_SCRATCH_TABLES: list[str] = []


def clear_scratch(spark: SparkSession) -> None:
    """Remove what queries have written beside their results; call it when the results themselves are written."""
    while _SCRATCH_TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_SCRATCH_TABLES.pop()}")
    while _SCRATCH_FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH_FOLDERS.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_folder(spark: SparkSession, kind: str = "llm") -> str:
    """A new folder below the shared one, which :func:`clear_scratch` removes."""
    folder = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    _SCRATCH_FOLDERS.append(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and return a scan of it.

    This cuts the lineage: a lost executor costs a re-read, and every later reader sees the same rows.
    """
    path = f"{scratch_folder(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by_key(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write a bucketed table, so that later joins on ``key`` need not shuffle this side."""
    spark, table = df.sparkSession, f"llm_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{table}"
    _SCRATCH_FOLDERS.append(path)
    _SCRATCH_TABLES.append(table)
    (
        df.write.format("parquet")
        .option("compression", "zstd")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return spark.table(table)


def find_package(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver has found it, beside their own path."""
    root, path = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, path]))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(docs: DataFrame, bucket_bytes: int) -> int:
    """Buckets for a table made of texts, so that a bucket holds about as much at any size of the table.

    There are as many as shuffle partitions at least, and at most as many as Spark allows.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(partitions(spark), -(-size // bucket_bytes)))


def as_given(docs: DataFrame) -> DataFrame:
    """All columns of a table in one struct, ``given``, so that no name of theirs meets a name of an operator's."""
    return docs.select(F.struct("*").alias("given"))


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of each key in turn, from batches that are sorted by the keys.

    Holds one key's rows at a time.
    """
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        edges = [0, *_changes(batch, keys), batch.num_rows]
        for start, end in zip(edges, edges[1:], strict=False):
            key = tuple(batch.column(k)[start].as_py() for k in keys)
            if held and key != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(start, end - start))
    if held:
        yield current, pa.Table.from_batches(held)


def _changes(batch: pa.RecordBatch, keys: tuple[str, ...]) -> list[int]:
    if batch.num_rows < 2:
        return []
    changed = None
    for k in keys:
        column = batch.column(k)
        differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
        changed = differs if changed is None else pc.or_(changed, differs)
    return [i + 1 for i, c in enumerate(changed.to_pylist()) if c]
