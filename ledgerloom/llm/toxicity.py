"""Toxicity by two Kneser-Ney language models, one of toxic and one of ordinary documents.

The class is the context of a word: P(word | class) is what the class's labelled documents say
about it, less a discount, and for the rest backs off to the word's first five and first four
bytes (rare words are often forms of a known stem), and last to continuation counts that both
classes share: after how many different words an expression occurs in the whole corpus. With c
the labelled documents of a class that hold an expression and N their sum over the level,

    p4 = max(c4 - D, 0) / N4 + left4 * cont(stem4) / sum of cont
    p5 = max(c5 - D, 0) / N5 + left5 * cont(stem5) / cont(stem4) * p4
    p  = max(c - D, 0) / N + left * cont(word) / cont(stem5) * p5

where what the discount leaves to the next level is shared by both classes, as they differ in
size. An expression that neither class holds in more than D documents thus has no say of its
own: the ratio of the classes is that of its stem, or one.

A toxic document is mostly ordinary words, so its words are drawn from the toxic model with
probability ``SHARE`` and from the ordinary one else. The score compares the length-normalised
log-likelihoods of the text under both, the mean of log((1 - SHARE) + SHARE * p_toxic / p_ordinary),
beside 1 / length, and is calibrated on labelled documents of another fold.

Class counts come from a bounded sample (``MOST`` labelled documents a class) and keep at most
``KNOWN`` expressions a level. Continuation counts are exact and over all documents: every task
sends the distinct pairs of a word before and an expression once for each of its batches, and
whoever owns a pair's range counts it once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import labelled
from ledgerloom.llm.hashed_words import NOT_WORD, byte_planes, from_byte_planes, mix, sliced, word_hashes
from ledgerloom.llm.shared import learnt, partitions, scratch, tidied

#: Labelled documents for each class: for the counts, for the calibration.
MOST = 6000
CALIBRATION = 2000
COUNT_FOLDS, CALIBRATION_FOLDS = [2, 3, 4], [1]

#: Expressions of each level in the models, the most frequent ones.
KNOWN = 1 << 20
#: Taken off every count: what one labelled document holds is left to the next level.
DISCOUNT = 1.0
#: The part of a toxic document's words that the toxic model gives.
SHARE = 0.02

#: Pairs that a task makes distinct at once.
PAIRS = 1_000_000

STEMS = (5, 4)
WORD, STEM5, STEM4 = LEVELS = range(3)
START = np.uint64(0x5851F42D4C957F2D)  # stands before a text's first word
UNKNOWN = -1


def expressions(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of each word and its stems (by level), of the word before it, and the rows' offsets."""
    words, rows, *stems = word_hashes(column, NOT_WORD, starts_of=STEMS)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[rows[:-1][np.diff(rows) > 0]] = START
    return [words, *stems], before, rows


def _places(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where a sorted table holds the hashes; UNKNOWN where it does not."""
    if not len(table):
        return np.full(len(hashes), UNKNOWN)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return np.where(table[at] == hashes, at, UNKNOWN)


@dataclass
class Vocabulary:
    """The expressions that the class models know, by level: sorted hashes, place of the stem in the next level."""

    hashes: list[np.ndarray]
    parent: list[np.ndarray]

    @property
    def first(self) -> list[int]:
        """Numbers over all levels begin here; one more for the end."""
        return [0, *np.cumsum([len(h) for h in self.hashes]).tolist()]

    def deepest(self, found: list[np.ndarray]) -> np.ndarray:
        """The number of each word's deepest known expression."""
        first = self.first
        out = np.full(len(found[WORD]), UNKNOWN)
        left = np.arange(len(out))
        for level in LEVELS:
            at = _places(self.hashes[level], found[level][left])
            known = at != UNKNOWN
            out[left[known]] = at[known] + first[level]
            left = left[~known]
        return out

    def at_level(self, numbers: np.ndarray, level: int) -> np.ndarray:
        """The expression of ``level`` above each number; UNKNOWN where the number lies above that level."""
        first, out = self.first, np.array(numbers)
        for below in range(level):
            own = (out >= first[below]) & (out < first[below + 1])
            parent = self.parent[below][out[own] - first[below]]
            out[own] = np.where(parent == UNKNOWN, UNKNOWN, parent + first[below + 1])
        return np.where((out >= first[level]) & (out < first[level + 1]), out, UNKNOWN)


# Class counts.


def class_counts(texts: DataFrame) -> DataFrame:
    """``level, hash, parent, toxic, ordinary``: the documents of a sample (grade, text) that hold each expression."""

    def count(batches):
        for batch in batches:
            for part in sliced(batch, "text"):
                found, _, rows = expressions(part.column("text"))
                row = np.repeat(np.arange(part.num_rows), np.diff(rows))
                grade = part.column("grade").to_numpy().astype(np.int64)
                for level in LEVELS:
                    own, first, at = np.unique(found[level], return_index=True, return_inverse=True)
                    once = np.unique(row * len(own) + at) if len(own) else row
                    row_of, at = np.divmod(once, max(len(own), 1))
                    above = found[min(level + 1, STEM4)][first]
                    toxic = np.bincount(at[grade[row_of] == 1], minlength=len(own))
                    every = np.bincount(at, minlength=len(own))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(own), level, np.int32)),
                            pa.array(own.view(np.int64)),
                            pa.array(above.view(np.int64)),
                            pa.array(toxic),
                            pa.array(every - toxic),
                        ],
                        names=["level", "hash", "parent", "toxic", "ordinary"],
                    )

    counted = texts.mapInArrow(tidied(count), "level int, hash long, parent long, toxic long, ordinary long")
    return counted.groupBy("level", "hash", "parent").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def vocabulary(counts: DataFrame, known: int = KNOWN) -> tuple[Vocabulary, list[np.ndarray]]:
    """The expressions that a class holds in more than DISCOUNT documents, and their counts by class."""
    enough = counts.where((F.col("toxic") > DISCOUNT) | (F.col("ordinary") > DISCOUNT))
    tables = []
    for level in LEVELS:
        own = enough.where(F.col("level") == level).orderBy(F.desc(F.col("toxic") + F.col("ordinary")), "hash").limit(known)
        rows = own.select("hash", "parent", "toxic", "ordinary").toArrow()
        columns = [rows.column(k).to_numpy() for k in range(4)]
        order = np.argsort(columns[0].view(np.uint64))
        tables.append([c[order] for c in columns])
    hashes = [t[0].view(np.uint64) for t in tables]
    parent = [_places(hashes[k + 1], tables[k][1].view(np.uint64)) for k in (WORD, STEM5)]
    return Vocabulary(hashes, parent), [np.stack((t[2], t[3])).astype(float) for t in tables]


# Shared counts.


def _distinct(before: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, in order."""
    order = np.lexsort((numbers, before))
    before, numbers = before[order], numbers[order]
    fresh = np.ones(len(before), dtype=bool)
    fresh[1:] = (before[1:] != before[:-1]) | (numbers[1:] != numbers[:-1])
    return before[fresh], numbers[fresh]


def _packed(before: np.ndarray, numbers: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Ordered pairs as words before, how many pairs each has, and the gaps between its numbers."""
    first = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
    each = np.diff(np.append(first, len(before)))
    gaps = np.diff(numbers, prepend=0)
    gaps[first] = numbers[first]
    return byte_planes(np.diff(before[first], prepend=np.uint64(0))), byte_planes(each.astype("<u4")), byte_planes(gaps.astype("<u4"))


def _unpacked(before: bytes, each: bytes, numbers: bytes) -> tuple[np.ndarray, np.ndarray]:
    each = from_byte_planes(each, "<u4").astype(np.int64)
    gaps = from_byte_planes(numbers, "<u4").astype(np.int64)
    first = np.cumsum(each) - each
    sums = np.cumsum(gaps)
    numbers = sums - np.repeat(sums[first] - gaps[first], each)
    return np.repeat(np.cumsum(from_byte_planes(before, "<u8"), dtype=np.uint64), each), numbers.astype(np.int32)


def continuations(docs: DataFrame, known: Vocabulary) -> np.ndarray:
    """By number: after how many different words each known expression occurs in all documents.

    The ranges that pairs are dealt out by are as many as shuffle partitions; a range takes some
    50 bytes of memory for each of its pairs.
    """
    ranges = partitions(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(known)
    total = known.first[-1]

    def pack(known, held):
        before, numbers = _distinct(*(np.concatenate(c) for c in zip(*held, strict=True)))
        stem = known.at_level(numbers, STEM4).astype(np.uint64)
        part = (mix(before + stem) % np.uint64(ranges)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        before, numbers, part = before[order], numbers[order], part[order]
        bounds = np.searchsorted(part, np.arange(ranges + 1))
        rows = [(k, *_packed(before[a:b], numbers[a:b])) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if a < b]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        names = ["part", "before", "each", "numbers"]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def pairs(batches):
        known = sent.value
        learnt("toxicity")
        held, n = [], 0
        for batch in batches:
            for part in sliced(batch, "text"):
                found, before, _ = expressions(part.column("text"))
                numbers = known.deepest(found)
                some = numbers != UNKNOWN
                held.append((before[some], numbers[some].astype(np.int32)))
                n += int(some.sum())
                if n >= PAIRS:
                    yield pack(known, held)
                    held, n = [], 0
        if n:
            yield pack(known, held)

    def count(batches):
        known = sent.value
        held = [
            _unpacked(*row)
            for batch in batches
            for row in zip(*(batch.column(c).to_pylist() for c in ("before", "each", "numbers")), strict=True)
        ]
        if not held:
            return
        before, numbers = _distinct(*(np.concatenate(c) for c in zip(*held, strict=True)))
        held.clear()
        for level in LEVELS:
            # All pairs of a word before and a stem are in this range, whatever follows the stem.
            own = known.at_level(numbers, level)
            some = own != UNKNOWN
            number, n = np.unique(_distinct(before[some], own[some])[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(n)], names=["number", "n"])

    counted = (
        docs.select(F.col("text").cast("string"))
        .mapInArrow(tidied(pairs), "part int, before binary, each binary, numbers binary")
        .repartitionById(ranges, F.col("part"))
        .mapInArrow(tidied(count), "number long, n long")
        .groupBy("number")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # a row for each known expression at most
    )
    sent.unpersist()
    out = np.zeros(total)
    out[counted.column(0).to_numpy()] = counted.column(1).to_numpy()
    return out


# The models.


@dataclass
class Model:
    hashes: list[np.ndarray]  # known expressions by level, sorted
    evidence: list[np.ndarray]  # log((1 - SHARE) + SHARE * p_toxic / p_ordinary) of each
    weights: np.ndarray  # of its mean, of 1 / length, 1

    def features(self, column: pa.Array) -> np.ndarray:
        found, _, rows = expressions(column)
        value = np.zeros(len(found[WORD]))
        left = np.arange(len(value))
        for level in LEVELS:
            at = _places(self.hashes[level], found[level][left])
            known = at != UNKNOWN
            value[left[known]] = self.evidence[level][at[known]]
            left = left[~known]
        sums = np.concatenate(([0.0], np.cumsum(value)))
        n = np.maximum(np.diff(rows), 1)
        return np.stack(((sums[rows[1:]] - sums[rows[:-1]]) / n, 1 / n, np.ones(len(n))), axis=1)

    def score(self, column: pa.Array) -> np.ndarray:
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        parts = [self.features(part.column("text")) @ self.weights for part in sliced(batch, "text")]
        z = np.concatenate(parts) if parts else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def probabilities(
    known: Vocabulary, counts: list[np.ndarray], sums: np.ndarray, taken: np.ndarray, shared: np.ndarray
) -> list[np.ndarray]:
    """By level: of each known expression the probability under toxic and under ordinary.

    ``sums`` and ``taken`` hold, by level and class, the sum of all counts and what DISCOUNT takes off it.
    """
    first = known.first
    cont = [np.maximum(shared[first[k] : first[k + 1]], 1) for k in LEVELS]
    out: list[np.ndarray] = [np.zeros((2, 0))] * 3
    for level in reversed(LEVELS):
        own = np.maximum(counts[level] - DISCOUNT, 0) / np.maximum(sums[level], 1)[:, None]
        left = taken[level].sum() / max(sums[level].sum(), 1)
        if level == STEM4:
            out[level] = own + left * cont[level] / cont[level].sum()
        else:
            # The stem is known as well, unless KNOWN left it out; then it says nothing.
            above = known.parent[level]
            some = above != UNKNOWN
            rest = np.broadcast_to(cont[level] / cont[level].sum(), (2, len(above))).copy()
            rest[:, some] = np.minimum(cont[level][some] / cont[level + 1][above[some]], 1) * out[level + 1][:, above[some]]
            out[level] = own + left * rest
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by Newton's method, halving steps that lose; a small ridge; both classes weigh the same."""
    size = x.std(axis=0)
    size[size == 0] = 1
    x = x / size
    each = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    ridge = 1e-4

    def loss(w):
        z = x @ w
        return (each * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * w @ w

    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (each * (y - p)) - ridge * w
        curve = (x * (each * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
    return w / size


def train(docs: DataFrame, labels: DataFrame, most: int = MOST, calibration: int = CALIBRATION, known: int = KNOWN) -> Model:
    """Learns from ``labels`` (doc_id, toxic) of folds 1 to 4 and the texts of all ``docs``.

    Without labelled documents the models are equal and every score is the constant of an
    ordinary text without words.
    """
    toxic = F.col("toxic")
    with scratch(docs.sparkSession, "toxicity") as work:
        samples = {
            0: labelled.sample(labels, toxic, [0, 1], COUNT_FOLDS, most),
            1: labelled.sample(labels, toxic, [0, 1], CALIBRATION_FOLDS, calibration),
        }
        texts = work.store(labelled.parted_texts(docs, samples))
        counts = work.store(class_counts(texts.where("part = 0").select("grade", "text")))
        per_level = counts.groupBy("level").agg(
            *(F.sum(c).alias(c) for c in ("toxic", "ordinary")),
            *(F.sum(F.least(F.col(c).cast("double"), F.lit(DISCOUNT))).alias(f"{c}_off") for c in ("toxic", "ordinary")),
        )
        sums, taken = np.zeros((3, 2)), np.zeros((3, 2))
        for row in per_level.collect():  # three rows
            sums[row["level"]] = row["toxic"], row["ordinary"]
            taken[row["level"]] = row["toxic_off"], row["ordinary_off"]
        words, by_class = vocabulary(counts, known)
        p = probabilities(words, by_class, sums, taken, continuations(docs, words))
        evidence = [np.log((1 - SHARE) + SHARE * own[0] / own[1]).astype(np.float32) for own in p]
        model = Model(words.hashes, evidence, np.zeros(3))
        sent = docs.sparkSession.sparkContext.broadcast(model)

        def measure(batches):
            for batch in batches:
                for part in sliced(batch, "text"):
                    found = sent.value.features(part.column("text"))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("grade"), *(pa.array(found[:, k].copy()) for k in range(2))],
                        names=["grade", "a", "b"],
                    )

        rows = texts.where("part = 1").select("grade", "text").mapInArrow(tidied(measure), "grade int, a double, b double").toArrow()
        sent.unpersist()
    y, *x = (rows.column(k).to_numpy() for k in range(3))
    # Beside the calibration rows, one that keeps texts without words on the ordinary side.
    x = np.concatenate((np.stack((*x, np.ones(len(y))), axis=1), [[0.0, 1.0, 1.0]]))
    model.weights = _logistic(x, np.append(y, [0]))
    return model


def score_column(docs: DataFrame, model: Model) -> Column:
    """The score of ``text``, 0 to 1; texts without words (null, empty) have one score of their own."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        learnt("toxicity")
        yield from tidied(lambda own: (pa.array(sent.value.score(text)) for text in own))(texts)

    return score(F.col("text").cast("string"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Rows with equal texts score the same; repeated rows are scored each for itself; a null
    doc_id is in no fold and not held out. Texts of any length are read whole, in slices. No
    ``docs`` give no rows; see ``train`` for no ``labels``. Only ``text`` enters a score; other
    columns are not read.
    """
    model = train(docs, labels)
    return docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(labelled.fold() == 0, F.lit(False)).alias("held_out"),
        score_column(docs, model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
