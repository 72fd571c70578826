"""Quality by ordinal regression with cumulative links on graded ratings.

One weight vector over hashed features of the text gives a document's position on a scale;
ordered thresholds on that scale separate the grades. From both come the expected grade and
the probability of at least a given grade, by which documents are selected.

Features are hashed words, hashed shapes of neighbouring words, and whether a word repeats
one of the two before it. A document's value for a feature is the feature's share of its
words, so its position is a mean over its words and texts of any length weigh the same.

The regression is fitted on up to ``MOST`` documents of each grade: their features are
stored once, every step's gradient is summed over them by Spark, a vector of ``CELLS``
numbers a task, and the driver only moves the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import labelled
from ledgerloom.llm.hashed_words import WHITE, mix, sliced, text_bytes, word_hashes
from ledgerloom.llm.shared import Scratch, tidied

BITS = 16
CELLS = 1 << BITS

#: Documents for each grade, tasks that share them, steps of the fit.
MOST = 1500
TASKS = 6
STEPS = 40
RATE = 0.5
RIDGE = 1e-6

LEARNING_FOLDS = [1, 2, 3, 4]
GRADES = [0, 1, 2]

# Kinds of bytes that make up a word's shape.
KIND = np.zeros(256, dtype=np.uint64)
KIND[ord("a") : ord("z") + 1] = 1
KIND[ord("A") : ord("Z") + 1] = 2
KIND[ord("0") : ord("9") + 1] = 4
KIND[128:] = 1
KIND[[c for c in range(33, 128) if not chr(c).isalnum()]] = 8
KIND[[ord(c) for c in ".,;:"]] = 16


def grades(labels: DataFrame) -> Column:
    """0 poor, 1 readable but toxic, 2 good, from quality and toxic of 0 or 1; null if quality is."""
    return F.when(labels["quality"] == 0, 0).when(labels["quality"] == 1, 2 - F.coalesce(labels["toxic"], F.lit(0)))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all features of a text column, three for each word, and the rows' offsets in words."""
    words, rows = word_hashes(column, WHITE)
    n = len(words)
    if not n:
        return np.zeros((3, 0), np.int64), rows
    # A word's shape: which kinds of bytes it holds and how long it is.
    data, starts = text_bytes(column)
    inside = ~WHITE[data]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    fresh[starts[starts < len(data)]] |= inside[starts[starts < len(data)]]
    begin = np.flatnonzero(fresh)
    held = np.bitwise_or.reduceat(KIND[data], begin)
    length = np.add.reduceat(inside.astype(np.uint64), begin)
    shape = held * np.uint64(8) + np.minimum(length // np.uint64(4), 7)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    before = np.where(np.concatenate(([True], row[1:] != row[:-1])), 0, np.concatenate((shape[:1], shape[:-1])))
    repeats = np.zeros(n, dtype=np.uint64)
    for back in (1, 2):
        same = (words[back:] == words[:-back]) & (row[back:] == row[:-back])
        repeats[back:] |= same.astype(np.uint64) << np.uint64(back)
    kinds = (words, shape * np.uint64(1 << 20) + before.astype(np.uint64), repeats)
    return np.stack([(mix(k + np.uint64(s)) >> np.uint64(64 - BITS)).astype(np.int64) for s, k in enumerate(kinds)]), rows


def means(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return (sums[rows[1:]] - sums[rows[:-1]]) / np.maximum(np.diff(rows), 1)


def tails(z: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Probabilities of at least grade 1, 2, ..., a column each."""
    return 1 / (1 + np.exp(-np.clip(z[:, None] - thresholds[None, :], -30, 30)))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def position(self, column: pa.Array) -> np.ndarray:
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        out = []
        for part in sliced(batch, "text"):
            cells, rows = features(part.column("text"))
            out.append(means(self.weights[cells].sum(axis=0), rows))
        return np.concatenate(out) if out else np.zeros(0)


def _gradient(z: np.ndarray, grade: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Slopes of the log-likelihood by position and by threshold, and the log-likelihood."""
    n, k = len(z), len(thresholds)
    p = np.concatenate((np.ones((n, 1)), tails(z, thresholds), np.zeros((n, 1))), axis=1)
    at = np.arange(n)
    upper, lower = p[at, grade], p[at, grade + 1]
    own = np.maximum(upper - lower, 1e-9)
    up, low = upper * (1 - upper) / own, lower * (1 - lower) / own
    by_threshold = np.zeros(k)
    np.add.at(by_threshold, np.maximum(grade - 1, 0), np.where(grade > 0, -up, 0))
    np.add.at(by_threshold, np.minimum(grade, k - 1), np.where(grade < k, low, 0))
    return up - low, by_threshold, float(np.log(own).sum())


def train(docs: DataFrame, labels: DataFrame, most: int = MOST, steps: int = STEPS) -> Model:
    """Fits ``labels`` (doc_id, quality, toxic) of folds 1 to 4 on the texts of ``docs``.

    Every grade weighs the same. A grade without documents leaves its thresholds at the start.
    """
    spark = docs.sparkSession
    kept = Scratch(spark, "quality")
    chosen = labelled.sample(labels, grades(labels), GRADES, LEARNING_FOLDS, most)

    def describe(batches):
        for batch in batches:
            for part in sliced(batch, "text"):
                cells, rows = features(part.column("text"))
                own = [cells[:, a:b].astype(np.uint16).tobytes() for a, b in zip(rows[:-1], rows[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("grade"), pa.array(own, pa.binary())], names=["grade", "cells"])

    described = kept.store(
        labelled.texts(docs, chosen).mapInArrow(tidied(describe), "grade int, cells binary").repartition(TASKS)
    )
    counts = {row["grade"]: row["n"] for row in described.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    if not counts:
        kept.remove()
        return Model(np.zeros(CELLS), np.array([-1.0, 0.0]))
    each = {grade: 1 / (len(counts) * n) for grade, n in counts.items()}

    def slopes(weights, thresholds):
        def run(batches):
            by_cell, by_threshold, total = np.zeros(CELLS), np.zeros(len(thresholds)), 0.0
            for batch in batches:
                grade = batch.column("grade").to_numpy().astype(np.int64)
                cells = [np.frombuffer(c, np.uint16).reshape(3, -1) for c in batch.column("cells").to_pylist()]
                rows = np.concatenate(([0], np.cumsum([c.shape[1] for c in cells])))
                cells = np.concatenate(cells, axis=1)
                z = means(weights[cells].sum(axis=0), rows)
                size = np.maximum(np.diff(rows), 1)
                weigh = np.array([each[g] for g in grade.tolist()])
                for own in np.unique(grade).tolist():
                    some = grade == own
                    by_z, by_t, likelihood = _gradient(z[some], grade[some], thresholds)
                    by_threshold += by_t * each[own]
                    total += likelihood * each[own]
                    weigh[some] *= by_z
                per_word = np.repeat(weigh / size, np.diff(rows))
                for kind in cells:
                    by_cell += np.bincount(kind, weights=per_word, minlength=CELLS)
            yield pa.RecordBatch.from_pydict(
                {"by_cell": pa.array([by_cell.tobytes()], pa.binary()),
                 "by_threshold": pa.array([by_threshold.tobytes()], pa.binary()), "total": [total]}
            )

        found = described.mapInArrow(tidied(run), "by_cell binary, by_threshold binary, total double").toArrow().to_pylist()
        return (
            sum(np.frombuffer(row["by_cell"]) for row in found),
            sum(np.frombuffer(row["by_threshold"]) for row in found),
        )

    # The thresholds are a first one and the roots of the steps up from it, so they stay in order.
    weights, free = np.zeros(CELLS), np.array([-1.0, 1.0])
    memory = [np.zeros(CELLS + 2), np.zeros(CELLS + 2)]
    for step in range(1, steps + 1):
        thresholds = np.array([free[0], free[0] + free[1] ** 2])
        by_cell, by_threshold = slopes(weights, thresholds)
        by_free = np.array([by_threshold.sum(), by_threshold[1] * 2 * free[1]])
        slope = np.concatenate((by_cell - RIDGE * weights, by_free))
        memory[0] = 0.9 * memory[0] + 0.1 * slope
        memory[1] = 0.99 * memory[1] + 0.01 * slope**2
        move = memory[0] / (1 - 0.9**step) / (np.sqrt(memory[1] / (1 - 0.99**step)) + 1e-6)
        weights, free = weights + RATE * move[:CELLS], free + 0.1 * RATE * move[CELLS:]
    kept.remove()
    return Model(weights, np.array([free[0], free[0] + free[1] ** 2]))


def position_column(docs: DataFrame, model: Model) -> Column:
    """Where ``text`` lies on the scale; texts without words lie at 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def position(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from tidied(lambda own: (pa.array(sent.value.position(text)) for text in own))(texts)

    return position(F.col("text").cast("string"))


def tail_column(position: Column, threshold: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(float(threshold)) - position))


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, expected_grade, p_readable, p_good, keep`` for every row of ``docs``.

    Null and empty texts have position 0 on the scale, like a text of which nothing is known.
    Texts of any length are read whole, in slices. Repeated rows are rated each for itself, null ids
    as any other; only ``text`` is looked at. No ``docs`` give no rows, and without ``labels`` all
    weights are 0.
    ``keep``: at least grade 1 with a probability of one half or more.
    """
    model = train(docs, labels)
    found = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(labelled.fold() == 0, F.lit(False)).alias("held_out"),
        position_column(docs, model).alias("z"),
    )
    first, second = (tail_column(F.col("z"), t) for t in model.thresholds)
    return found.select(
        "doc_id",
        "held_out",
        (first + second).alias("expected_grade"),
        first.alias("p_readable"),
        second.alias("p_good"),
        (first >= 0.5).alias("keep"),
    )
