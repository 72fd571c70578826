"""Bounded, reproducible samples of labelled documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out from all learning."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def sample(labels: DataFrame, grade: Column, grades: list[int], folds: list[int], most: int) -> DataFrame:
    """``doc_id, grade`` of up to ``most`` documents of each grade in the given folds.

    A document with several label rows has its largest grade; null ids and grades are left
    out. Which documents are taken hangs on a hash of their ids alone.
    """
    graded = (
        labels.select("doc_id", grade.cast("int").alias("grade"))
        .where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull())
        .where(fold().isin(folds))
        .groupBy("doc_id")
        .agg(F.max("grade").alias("grade"))
    )
    return reduce(
        DataFrame.union,
        (graded.where(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for g in grades),
    )


def parted_texts(docs: DataFrame, parts: dict[int, DataFrame]) -> DataFrame:
    """``part, grade, text`` of several samples in one reading of ``docs``; each part's rows are bounded, as in ``sample``."""
    chosen = reduce(DataFrame.union, (rows.select("doc_id", "grade", F.lit(part).alias("part")) for part, rows in parts.items()))
    return docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").select("part", "grade", "text")


def texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``grade, text`` of a sample; its rows are bounded by its parameters, so it goes to all executors."""
    return docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").select("grade", "text")
