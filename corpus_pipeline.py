"""A training corpus from ``documents``, stage by stage.

Every stage takes what the one before it kept. The first four filter documents and return
them with the columns they came with; the last packs what is left into sequences.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, ngram_join, packing, quality
from ledgerloom.llm import toxicity as toxic
from ledgerloom.llm.queries import tokenizer
from ledgerloom.llm.shared import Scratch, broadcast_if_few, table

#: From this score (toxicity), below this probability of a readable text (quality), a document goes.
TOXIC = 0.5
READABLE = 0.5


def marked(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, Column]:
    """``rows`` (doc_id, copy) to join with ``docs``, under names that no column of ``docs`` has, and the condition.

    ``copy`` is xxhash64 of the text.
    """
    taken = {c.lower() for c in docs.columns}
    free = (f"row_{k}" for k in count())
    names = [next(n for n in free if n not in taken) for _ in range(2)]
    rows = broadcast_if_few(rows.select("doc_id", "copy")).toDF(*names)
    same = docs["doc_id"].eqNullSafe(F.col(names[0])) & (F.xxhash64(docs["text"]) == F.col(names[1]))
    return rows, docs["text"].isNotNull() & same


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` less the rows whose doc_id and text are in ``rows`` (a stored table of distinct doc_id, copy).

    Other texts under the same id, or without one, stay.
    """
    return docs.join(*marked(docs, rows), "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a toxicity score below TOXIC; texts without words (null, empty) stay.

    Each row is judged by its text alone, whatever its id and other columns; repeated rows are
    judged alike. No documents give no rows, and without labels all stay.
    """
    model = toxic.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxic.score_column(docs, model) < TOXIC)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are readable or good with a probability of READABLE or more.

    Each row is judged by its text alone, whatever its id and other columns; repeated rows are
    judged alike. No documents give no rows.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    readable = quality.tail_column(quality.position_column(docs, model), model.thresholds[0])
    return docs.where(readable >= READABLE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group, that with the smallest doc_id.

    Every text is decided for itself: of different texts under that id, and of rows with one
    doc_id and equal texts, one stays. Rows without a doc_id are compared among themselves, and
    one of each group stays, beside the named one if there is any. Texts without words are in
    no group and all stay. No documents give no rows; other columns may have any name.
    """
    kept = Scratch(spark, "near-duplicates")
    found = kept.store(ngram_join.near_duplicate_rows(docs))
    rows = kept.store(found.groupBy("part", "doc_id", "copy").agg(F.count("*").alias("n")))
    unnamed = F.col("doc_id").isNull().alias("unnamed")
    groups = rows.groupBy("part", unnamed).agg(F.min(F.struct("doc_id", "copy")).alias("first"), F.sum("n").alias("all"))
    # Rows alone in their group need no second look.
    groups = kept.store(groups.where("all > 1"))
    judged = rows.withColumn("unnamed", unnamed).join(broadcast_if_few(groups), ["part", "unnamed"])
    judged = judged.withColumn("stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("copy") == F.col("first.copy")))
    judged = kept.store(judged.select("doc_id", "copy", "n", "stays"))
    left = without(docs, kept.store(judged.where("not stays").select("doc_id", "copy")))
    # A corpus with clean ids has no row that repeats, and is not looked at again.
    several = kept.store(judged.where("stays and n > 1").select("doc_id", "copy"))
    if several.limit(1).count() == 0:
        return left
    again = left.join(*marked(left, several), "left_semi").dropDuplicates(["doc_id", "text"])
    return without(left, several).unionByName(again)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item, with its own or other values in its slots.

    Every text is decided for itself; repeated rows go or stay together, and null texts stay. No
    documents give no rows, and without benchmark items all stay. Other columns may have any name.
    """
    kept = Scratch(spark, "decontamination")
    found = decontaminate.held(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, kept.store(found.select("doc_id", "copy").distinct()))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places all documents in sequences of 4096 tokens.

    Repeated rows, equal and null ids are documents of their own, a null text is an empty one.
    No documents give no rows; other columns are not read.
    """
    return packing.packed_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Trained models and packing are beyond SQL; the tests hold labels, and brute-force versions of single operators, against the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    kept = Scratch(spark, "corpus")
    for _, stage in STAGES:
        docs = kept.store(stage(spark, docs, sf_dir))
    return docs
