"""Catalog tables: safe replacing, counting, and staging of intermediate results."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from invoicelake.sources import files

# Session setting: a shared folder for the tables, where the catalog does not outlive the process.
TABLE_PATH = "spark.invoicelake.tablePath"
_VERSION = "version-"


def create_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def _table_folder(spark: SparkSession, name: str) -> str:
    """Folder of a table's versions: in the table folder (TABLE_PATH), else in the database's."""
    db, _, table = name.rpartition(".")
    folder = spark.conf.get(TABLE_PATH, None)
    home = f"{folder.rstrip('/')}/{db}" if folder else spark.catalog.getDatabase(db).locationUri.rstrip("/")
    return f"{home}/{table}"


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of the table's whole versions, the oldest first; one cut short lacks its mark."""
    return [
        name for name in files.names(spark, folder)
        if name.startswith(_VERSION) and files.exists(spark, f"{folder}/{name}/_SUCCESS")
    ]


def open_tables(spark: SparkSession, db: str, tables: tuple[str, ...]) -> None:
    """Make tables that an earlier process left in the table folder known to this catalog."""
    create_database(spark, db)
    if spark.conf.get(TABLE_PATH, None) is None:
        return
    for table in tables:
        name = f"{db}.{table}"
        folder = _table_folder(spark, name)
        versions = _versions(spark, folder)
        if versions and not spark.catalog.tableExists(name):
            _point(spark, name, f"{folder}/{versions[-1]}")


def overwrite_table(df: DataFrame, name: str) -> int:
    """Replace a Parquet table; returns the rows written, counted while writing.

    The rows go to a new folder, and the table is pointed to it when it is whole. So a job that fails
    leaves the table as it was, and no reader meets half a table. The version before stays for
    readers that are at it; older ones and those cut short are removed.
    """
    spark = df.sparkSession
    folder = _table_folder(spark, name)
    version = f"{_VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    before = files.names(spark, folder)
    whole = _versions(spark, folder)
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/{version}")
    rows = written.get["rows"]
    _point(spark, name, f"{folder}/{version}")
    for old in before:
        if old.startswith(_VERSION) and old not in whole[-1:]:
            files.remove(spark, f"{folder}/{old}")
    return rows


def _point(spark: SparkSession, name: str, folder: str) -> None:
    """Let the table `name` be the Parquet files in `folder`."""
    if spark.catalog.tableExists(name):
        held = [(f.name, f.dataType) for f in spark.table(name).schema]
        if held == [(f.name, f.dataType) for f in spark.read.parquet(folder).schema]:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")  # of other columns
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{folder}'")


def list_tables(spark: SparkSession, db: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary)


def row_counts(spark: SparkSession, db: str, tables: tuple[str, ...]) -> DataFrame:
    """(layer, row_count) of tables; the counts come from the Parquet footers."""
    counts = [
        spark.table(f"{db}.{name}").agg(
            F.lit(name).alias("layer"), F.count(F.lit(1)).alias("row_count")
        )
        for name in tables
    ]
    out = counts[0]
    for count in counts[1:]:
        out = out.unionByName(count)
    return out


def preview(spark: SparkSession, db: str, table: str, rows: int = 20) -> DataFrame:
    """Some rows of a table; only as many of its files are read as it takes."""
    return spark.table(f"{db}.{table}").limit(rows)


def staged(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """`df` written once and read back, for results that several jobs need.

    The copy lies in the cluster's shared checkpoint folder, so it survives lost executors. Every
    call has a folder of its own: runs at the same time, or one after the other, do not meet.
    Readers get only the columns they use, and of `partitions` only those they ask for.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/invoicelake/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines of the cluster share.

    Without `spark.checkpoint.dir` it is in the warehouse; a warehouse on each machine's own disk
    will do only where there is one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir") + "/_staging"
    if files.is_local(spark, folder) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a shared folder; {folder} is on each machine's own disk")
    return folder
