"""Table sinks: parquet tables, CSV exports, temp views."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


class LazyTables(dict):
    """Tables by name, each planned when first asked for and then shared."""

    def __init__(self, plan: Callable[[str], DataFrame]) -> None:
        super().__init__()
        self._plan = plan

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._plan(name)
        return self[name]


#: Rows that a task of a dealt table gets at most, as its sorts and aggregates may hold all of them.
ROWS_A_TASK = 1 << 18


def dealt_out(df: DataFrame, *key: str, rows: int = ROWS_A_TASK, spread: bool = True) -> DataFrame:
    """Deal a scan of fewer splits than there are cores, or of splits with too many rows, out by a key.

    A file of a single row group is one task's, however many splits it counts as; what follows the scan would
    run in that task too, up to the next shuffle. The number of tasks grows with the rows, which the footers tell,
    so that what one task holds does not. Other tables are left as they are, and so are few splits of few rows
    where a table is not to be spread over all cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    needed = -(-df.count() // rows)
    files = len(df.inputFiles())
    if (spread and files < cores) or min(files, df.rdd.getNumPartitions()) < needed:
        return df.repartition(max(cores, needed), *key)
    return df


def write_table(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write a parquet table, replacing what is there, and return a scan of it.

    Later readers start from the files, so a lost executor costs a re-read and
    not the plan that made the table.
    """
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    return {name: write_table(df, f"{folder}/{name}") for name, df in tables.items()}


def _written_version(database: str, name: str) -> str | None:
    """The version that the view of this name reads, if there is one."""
    spark = SparkSession.active()
    if not spark.catalog.tableExists(f"{database}.{name}"):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").filter("col_name = 'View Text'").collect()
    found = re.search(rf"{name}__v\w+", described[0].data_type) if described else None
    return found[0] if found else None


def write_version(df: DataFrame, database: str, name: str, version: str, key: Sequence[str] = (), buckets: int = 0) -> str:
    """Write one table of a build that nobody reads yet, in buckets of its key where it has one; the table's name.

    A reader that groups or joins by the key of a bucketed table needs no shuffle of it. Choose the buckets so that
    one of them suits a task; by default there are as many as shuffle partitions.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    table = f"{database}.{name}__v{version}"
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if key:
        writer = writer.bucketBy(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), *key).sortBy(*key)
    writer.saveAsTable(table)
    return table


def publish(written: Mapping[str, str], database: str) -> None:
    """Switch the views of a database to newly written tables.

    Until then readers see the former tables whole, and from then on the new ones; a build that fails before it
    changes nothing. The tables that the views read before are kept for whoever still reads them, up to the
    next switch; versions older than those, and versions that were never published, are dropped.
    """
    spark = SparkSession.active()
    former = {name: _written_version(database, name) for name in written}
    for name, table in written.items():
        if former[name] is None:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {table}")
    for name, table in written.items():
        kept = {table.split(".")[-1], former[name]}
        for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__v*'").collect():
            if row.tableName not in kept:
                spark.sql(f"DROP TABLE IF EXISTS {database}.{row.tableName}")


def save_tables(
    tables: Mapping[str, DataFrame], database: str, keys: Mapping[str, Sequence[str]] | None = None, buckets: int = 0
) -> dict[str, DataFrame]:
    """Write all tables beside the published ones, then publish them together; scans of them by name."""
    version, spark = uuid.uuid4().hex, next(iter(tables.values())).sparkSession
    written = {n: write_version(df, database, n, version, (keys or {}).get(n, ()), buckets) for n, df in tables.items()}
    publish(written, database)
    return {name: spark.table(f"{database}.{name}") for name in tables}


def create_views(tables: dict[str, DataFrame]) -> None:
    """Expose lazy tables to SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_csv(df: DataFrame, path: str, single_file: bool = False, compression: str = "none") -> None:
    """Write a headed CSV folder in parallel, text as it is; one file only on request, for small tables."""
    (
        (df.coalesce(1) if single_file else df)
        .write.mode("overwrite")
        .options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .option("compression", compression)
        .csv(path)
    )


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
