"""Ranked lexical search: term at a time over short lists, document at a time over long ones.

The corpus is cut into slabs of some thousand documents, each with its own inverted lists:

1. ``index_slabs``: one pass over the texts. A slab is one row of packed arrays: terms (as 64-bit
   hashes), the documents of each term's list, how often they hold it, the documents' ids and
   lengths. Where the items' terms are few enough to be sent to all tasks, other terms are left out.
2. Statistics over all slabs (documents, terms, documents of each term) give the weights.
3. ``search_slab``: each item is searched in each slab. The lists of its rare terms are summed term
   at a time into accumulators. Those are one more list from then on, with the largest accumulator
   as its bound, beside the lists of frequent terms, whose bounds are their largest values. The
   lists are read document at a time, in strides: lists whose bounds together stay below the
   score of the k-th best so far cannot bring a document in by themselves, so only the others
   are read on; their documents look the rest up, from the largest bound to the smallest, and
   are left as soon as what remains cannot lift them to that score.
4. The best of all slabs together.

Slabs meet items in groups of bounded size, whatever the number of either; a group keeps one list
of best documents for each item, so the score to reach grows from slab to slab.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.hashed_words import NOT_WORD, sliced, word_hashes
from ledgerloom.llm.shared import BROADCAST_ROWS, Scratch, scratch, tidied

K = 50

#: Documents and list entries of a slab, entries of a group of slabs, terms of a chunk of items.
SLAB_DOCS = 8192
SLAB_ENTRIES = 400_000
GROUP_ENTRIES = 4_000_000
CHUNK_TERMS = 200_000

#: Documents of a stride; short lists are summed until they hold this part of a slab's documents.
STRIDE = 2048
SHORT = 0.25

SLAB = (
    "slab long, n_docs long, with_terms long, n_terms long, entries long, "
    "terms binary, starts binary, docs binary, times binary, ids binary, named binary, lengths binary"
)


# 1. The index.


def index_slabs(docs: DataFrame, listed: np.ndarray | None) -> DataFrame:
    """Rows of SLAB: inverted lists of the terms in ``listed`` (sorted hashes; None: of all terms)."""
    sent = None if listed is None else docs.sparkSession.sparkContext.broadcast(listed)

    def slab(held, ids, lengths):
        terms, at, times = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((at, terms))
        terms, at, times = terms[order], at[order], times[order]
        starts = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1]))) if len(terms) else terms.astype(np.int64)
        own = np.concatenate(ids)
        n = np.concatenate(lengths)
        named = np.array([i is not None for i in own], dtype=bool)
        row = {
            "slab": 0,
            "n_docs": len(own),
            "with_terms": int((n > 0).sum()),
            "n_terms": int(n.sum()),
            "entries": len(terms),
            "terms": terms[starts].astype("<u8").tobytes(),
            "starts": np.append(starts, len(terms)).astype("<u4").tobytes(),
            "docs": at.astype("<u4").tobytes(),
            "times": times.astype("<u4").tobytes(),
            "ids": np.array([i or 0 for i in own], "<i8").tobytes(),
            "named": named.tobytes(),
            "lengths": n.astype("<i8").tobytes(),
        }
        kinds = [pa.int64()] * 5 + [pa.binary()] * 7
        return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row.values(), kinds, strict=True)], names=list(row))

    def run(batches: Iterator[pa.RecordBatch]):
        held, ids, lengths = [], [], []
        entries = n_docs = 0
        for batch in batches:
            for part in sliced(batch, "text"):
                words, rows = word_hashes(part.column("text"), NOT_WORD)
                row = np.repeat(np.arange(part.num_rows, dtype=np.int64), np.diff(rows))
                if sent is None:
                    names, at = np.unique(words, return_inverse=True)
                else:
                    names = sent.value
                    at = np.minimum(np.searchsorted(names, words), len(names) - 1) if len(names) else np.zeros(len(words), np.int64)
                    known = names[at] == words if len(names) else np.zeros(len(words), dtype=bool)
                    at, row = at[known], row[known]
                keys, times = np.unique(row * len(names) + at, return_counts=True) if len(at) else (at, at)
                row, at = np.divmod(keys, max(len(names), 1))
                held.append((names[at], row + n_docs, times))
                ids.append(np.array(part.column("doc_id").to_pylist(), dtype=object))
                lengths.append(np.diff(rows))
                entries += len(at)
                n_docs += part.num_rows
                if n_docs >= SLAB_DOCS or entries >= SLAB_ENTRIES:
                    yield slab(held, ids, lengths)
                    held, ids, lengths = [], [], []
                    entries = n_docs = 0
        if n_docs:
            yield slab(held, ids, lengths)

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(run), SLAB)
    return found.withColumn("slab", F.monotonically_increasing_id())


# 2. Items and weights.


def item_terms(items: DataFrame) -> DataFrame:
    """``item, term`` for the distinct terms of every row of ``items`` (item, text)."""

    def run(batches):
        for batch in batches:
            for part in sliced(batch, "text"):
                words, rows = word_hashes(part.column("text"), NOT_WORD)
                item = np.repeat(part.column("item").to_numpy(), np.diff(rows))
                yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(words.view(np.int64))], names=["item", "term"])

    return items.select("item", "text").mapInArrow(tidied(run), "item long, term long").distinct()


def weights(slabs: DataFrame, terms: DataFrame, n_docs: int) -> DataFrame:
    """``term, weight`` of the ``terms`` that documents hold."""

    def run(batches):
        for batch in batches:
            for held, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = np.diff(np.frombuffer(starts, "<u4").astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(held, "<i8")), pa.array(n)], names=["term", "n"])

    df = slabs.where("entries > 0").select("terms", "starts").mapInArrow(tidied(run), "term long, n long")
    df = df.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    share = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    return df.select("term", F.floor(F.lit(1000.0) * F.log(share)).cast("long").alias("weight"))


# 3. Search.


@dataclass
class Best:
    """An item's best documents so far."""

    k: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    named: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    @property
    def reach(self) -> int:
        """The least score that may still come in (with a smaller id, if it is that of the last)."""
        return max(int(self.scores[-1]), 1) if len(self.scores) == self.k else 1

    def take(self, scores, ids, named):
        scores, ids, named = (np.concatenate(c) for c in ((self.scores, scores), (self.ids, ids), (self.named, named)))
        order = np.lexsort((ids, ~named, -scores))[: self.k]
        self.scores, self.ids, self.named = scores[order], ids[order], named[order]


@dataclass
class Slab:
    """Inverted lists with each entry's value before its term's weight."""

    terms: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    values: np.ndarray
    most: np.ndarray  # largest value of each list
    ids: np.ndarray
    named: np.ndarray

    @classmethod
    def unpacked(cls, row, n_docs: int, n_terms: int) -> Slab:
        docs = np.frombuffer(row.docs, "<u4").astype(np.int64)
        times = np.frombuffer(row.times, "<u4").astype(np.int64)
        starts = np.frombuffer(row.starts, "<u4").astype(np.int64)
        lengths = np.frombuffer(row.lengths, "<i8")
        if len(lengths) and int(lengths.max()) * 50 * n_docs >= 1 << 63:
            m = np.array([50 + 50 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
        else:
            m = 50 + 50 * lengths * n_docs // max(n_terms, 1)
        values = 1_000_000_000 * times // (1000 * times + 20 * m[docs])
        most = np.maximum.reduceat(values, starts[:-1]) if len(values) else values
        return cls(
            np.frombuffer(row.terms, "<i8"), starts, docs, values, most,
            np.frombuffer(row.ids, "<i8"), np.frombuffer(row.named, bool),
        )


def search_slab(slab: Slab, terms: np.ndarray, weight: np.ndarray, best: Best) -> int:
    """Brings the slab's documents into ``best``; returns how many entries were read or looked up.

    ``terms`` are sorted as the slab's are (as unsigned numbers).
    """
    at = np.searchsorted(slab.terms.view(np.uint64), terms.view(np.uint64))
    at = np.minimum(at, max(len(slab.terms) - 1, 0))
    held = (slab.terms[at] == terms) & (weight > 0) if len(slab.terms) else np.zeros(len(terms), bool)
    at, weight = at[held], weight[held]
    lengths = slab.starts[at + 1] - slab.starts[at]
    order = np.argsort(lengths, kind="stable")
    short = order[np.cumsum(lengths[order]) <= SHORT * len(slab.ids)]
    read, sure = 0, 1  # a score that as many documents as are asked for are sure to have

    # Each list: documents, values, weight, bound.
    lists = []
    for k in order[len(short) :].tolist():
        own = slice(slab.starts[at[k]], slab.starts[at[k] + 1])
        lists.append((slab.docs[own], slab.values[own], int(weight[k]), int(weight[k] * slab.most[at[k]])))
    if len(short):
        docs = np.concatenate([slab.docs[slab.starts[t] : slab.starts[t + 1]] for t in at[short]])
        values = np.concatenate([w * slab.values[slab.starts[t] : slab.starts[t + 1]] for t, w in zip(at[short], weight[short], strict=True)])
        accumulated = np.zeros(len(slab.ids), np.int64)
        np.add.at(accumulated, docs, values)
        docs = np.flatnonzero(accumulated)
        values = accumulated[docs]
        read += len(docs)
        if len(docs):
            lists.append((docs, values, 1, int(values.max())))
        if len(docs) >= best.k:
            sure = int(np.partition(values, len(values) - best.k)[len(values) - best.k])
    lists.sort(key=lambda one: one[3])
    below = np.cumsum([one[3] for one in lists])

    for begin in range(0, len(slab.ids), STRIDE):
        reach = max(best.reach, sure)
        first = int(np.searchsorted(below, reach))  # the lists before it cannot reach it together
        if first == len(lists):
            break
        score = np.zeros(STRIDE, np.int64)
        ways = [np.searchsorted(one[0], (begin, begin + STRIDE)) for one in lists]
        for (docs, values, w, _), (a, b) in zip(lists[first:], ways[first:], strict=True):
            score[docs[a:b] - begin] += w * values[a:b]
            read += b - a
        some = np.flatnonzero(score)
        score = score[some]
        for k in range(first - 1, -1, -1):
            stay = score + below[k] >= reach
            some, score = some[stay], score[stay]
            if not len(some):
                break
            docs, values, w, _ = lists[k]
            a, b = ways[k]
            if a < b:
                place = a + np.minimum(np.searchsorted(docs[a:b], some + begin), b - a - 1)
                score = score + np.where(docs[place] == some + begin, w * values[place], 0)
                read += len(some)
        stay = score >= reach
        some, score = some[stay] + begin, score[stay]
        if len(some):
            best.take(score, slab.ids[some], slab.named[some])
    return read


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of ``docs`` with the highest scores above 0.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z
    lower-cased; they are compared as 64-bit hashes. Null and empty texts hold none, score
    nothing and are in no count. Texts of any length are read whole. Rows of ``docs`` are ranked
    each for itself, whatever their ids; equal scores rank the smaller doc_id first, a null one
    last. Equal rows of ``items`` (item_id, text) are one item, different texts under one item_id
    are searched and ranked each for itself. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    with scratch(spark, "lexical") as work:
        own = items.select("item_id", F.col("text").cast("string")).distinct()
        items = work.store(own.withColumn("item", F.monotonically_increasing_id()))
        asked = work.store(item_terms(items))
        terms = work.store(asked.select("term").distinct())
        listed = None
        if terms.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            listed = np.sort(terms.toArrow().column(0).to_numpy().view(np.uint64))
        slabs = work.store(index_slabs(docs, listed))
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("with_terms", "n_terms", "entries")]
        n_docs, n_terms, entries = slabs.agg(*sums).first()
        groups = max(1, -(-entries // GROUP_ENTRIES))

        weighted = work.store(asked.join(weights(slabs, terms, n_docs), "term"))
        chunks = max(1, -(-weighted.count() // CHUNK_TERMS))
        part = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
        all_ = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = slabs.where("entries > 0").select("*", part("slab", groups).alias("group"), all_(chunks).alias("chunk"))
        right = weighted.select("item", "term", "weight", part("item", chunks).alias("chunk"), all_(groups).alias("group"))

        def search(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
            found = {
                item: (terms.to_numpy(), own["weight"].to_numpy(), Best(k))
                for item, own in wanted.groupby("item")
                for terms in [own["term"]]
            }
            for row in rows.itertuples(index=False):
                slab = Slab.unpacked(row, n_docs, n_terms)
                for terms, weight, best in found.values():
                    search_slab(slab, terms, weight, best)
            return pd.DataFrame(
                [
                    (item, i if has else None, score)
                    for item, (_, _, best) in found.items()
                    for i, has, score in zip(best.ids.tolist(), best.named.tolist(), best.scores.tolist(), strict=True)
                ],
                columns=["item", "doc_id", "score"],
            ).astype({"doc_id": "Int64"})

        keys = ["chunk", "group"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "item long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        kept = Scratch(spark, "lexical")
        return kept.store(
            found.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .join(items.select("item", "item_id"), "item")
            .select("item_id", "rank", "doc_id", "score")
        )
