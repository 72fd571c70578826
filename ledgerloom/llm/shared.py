"""What the operators share: tables, stored intermediates, size-checked broadcasts."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.tables import fresh_folder, store

#: Rows of a table of ids or hashes that may be sent to every executor (some ten MB).
BROADCAST_ROWS = 500_000
#: Bytes of a table of wide rows that may be sent.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables stored below one fresh folder that all executors share, removed together."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = fresh_folder(spark, label)
        self.made = 0

    def store(self, df: DataFrame) -> DataFrame:
        self.made += 1
        return store(df, f"{self.folder}/{self.made}")

    def remove(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[Scratch]:
    """Intermediates that nothing needs any more when the block ends."""
    own = Scratch(spark, label)
    try:
        yield own
    finally:
        own.remove()


def broadcast_if_few(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a stored table of narrow rows) with a hint: sent whole up to ``limit`` rows, else merged."""
    few = df.limit(limit + 1).count() <= limit
    return F.broadcast(df) if few else df.hint("merge")


def broadcast_if_light(df: DataFrame, size: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a stored table) with a hint: sent whole while the sum of ``size`` (bytes of a row) is up to ``limit``, else merged."""
    light = (df.agg(F.sum(size)).first()[0] or 0) <= limit
    return F.broadcast(df) if light else df.hint("merge")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def joined_by_key(rows: DataFrame, keys: DataFrame, on: list[str], held: str, limit: int | None = None) -> DataFrame:
    """``rows`` joined with ``keys`` (a stored table, one row a key; ``held``: how many of ``rows`` have it).

    Few keys are sent whole. Of more, those with over an average partition of rows, which are no more
    than there are partitions, are sent, so their rows stay where they are; the others are merged.
    Every task's share is bounded, however many rows one key has.
    """
    limit = BROADCAST_ROWS if limit is None else limit
    if keys.limit(limit + 1).count() <= limit:
        return rows.join(F.broadcast(keys), on)
    ranges = partitions(keys.sparkSession)
    share = (keys.agg(F.sum(held)).first()[0] or 0) // ranges
    heavy = F.broadcast(keys.where(F.col(held) > share))
    light = keys.where(F.col(held) <= share).hint("merge")
    merged = rows.join(F.broadcast(keys.where(F.col(held) > share).select(*on)), on, "left_anti").join(light, on)
    return rows.join(heavy, on).unionByName(merged)


def give_back() -> None:
    """What a Python worker has freed goes back to the system: workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over batches that gives back what it freed when it ends."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


_learnt: dict[tuple, object] = {}


def learnt(*key, make: Callable[[], object] | None = None):
    """What a Python worker has learnt in earlier tasks of this kind; tasks of another kind end it.

    Workers serve one task after another, so what each kind of task kept would add up. A kind that
    keeps nothing names itself without ``make``.
    """
    if key not in _learnt:
        _learnt.clear()
        _learnt[key] = make() if make else None
    return _learnt[key]


def workers_find_package(spark: SparkSession) -> None:
    """Lets Python workers on this machine import this package from where the driver has it.

    On a cluster the package is installed or sent along; there nothing changes.
    """
    if spark.sparkContext.master.startswith("local["):
        root = str(Path(__file__).resolve().parents[2])
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)
