"""Stored tables, the catalog, and the shared folder for intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        # Not local-cluster, whose executors are processes with folders of their own.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


# Folders of intermediates, one list for each block of without_intermediates() that is open.
_passing: list[list[str]] = []


def fresh_folder(spark: SparkSession, label: str, *, passing: bool = False) -> str:
    """A path of its own below the shared folder.

    ``passing`` marks what is only needed until the enclosing
    :func:`without_intermediates` ends; outside of one it stays.
    """
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if passing and _passing:
        _passing[-1].append(path)
    return path


@contextmanager
def without_intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediates made inside, once what was made from them is stored.

    After a failure as well: nothing reads them any more then.
    """
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whichever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def store(df: DataFrame, path: str, *, find_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and return the stored rows: its plan is a plain scan.

    ``find_by`` names a column that is looked up by value; its row groups get
    a Bloom filter, so a look-up skips the row groups without the value.
    """
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if find_by is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{find_by}", "true")
        # Sized by the values found, not at the maximum for every row group.
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)
    # The schema is known, so no job is spent on reading file footers.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")


def save_table(df: DataFrame, database: str, table: str) -> DataFrame:
    """Replace the catalog table and return its rows."""
    name = f"`{database}`.`{table}`"
    df.write.mode("overwrite").option("compression", "zstd").saveAsTable(name)
    return df.sparkSession.table(name)


def save_copy(df: DataFrame, database: str, table: str) -> DataFrame:
    """A table of its own in a database that is already there; a view of that name gives way."""
    catalog = df.sparkSession.catalog
    name = f"`{database}`.`{table}`"
    if catalog.tableExists(name) and catalog.getTable(name).tableType == "VIEW":
        df.sparkSession.sql(f"DROP VIEW {name}")
    return save_table(df, database, table)


def save_view(spark: SparkSession, source: str, view: str, columns: Mapping[str, str]) -> None:
    """A catalog view of the table ``source`` with other column names (``{ours: shown}``)."""
    shown = ", ".join(
        f"`{name}` AS `{columns.get(name, name)}`" for name in spark.table(source).columns
    )
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {shown} FROM {source}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Saved tables of a database. Temporary views, which Spark lists as well, are left out."""
    return (
        spark.sql(f"SHOW TABLES IN `{database}`")
        .where("NOT isTemporary")
        .selectExpr("namespace AS database", "tableName AS table_name")
    )


def register_view(df: DataFrame, view: str, columns: Mapping[str, str] | None = None) -> None:
    """Give a frame a name for SQL, with other column names if asked (``{ours: shown}``)."""
    df.withColumnsRenamed(dict(columns or {})).createOrReplaceTempView(view)
