"""Exact top-k inner products in three phases with a uniform threshold.

A vector's components are split into ``LISTS`` lists; a score is the sum of one partial score
from each list, and every list is searched on its own:

1. Each list gives, for each query, its ``k`` best vectors by partial score. Their whole scores
   are worked out; the k-th best of those, t, is a safe cutoff: at least k vectors reach it.
2. The cutoff goes to all lists. Each gives every vector with a partial score of at least
   t / LISTS, and that score. A vector that no list gives stays below t, so nothing that belongs
   in the answer is missing. A vector that all lists give has its whole score by now, and the k-th
   best of those and of phase 1 is a second, higher cutoff. A vector that some lists do not give
   has less than t / LISTS there, so its score is bounded from above: what stays below the second
   cutoff goes.
3. The scores of the vectors that are left are worked out exactly, and the k best kept.

Queries and vectors meet in blocks of some ``QUERIES`` and ``BLOCK`` rows, each list of each pair of
blocks a task's matrix product, a bounded part of the queries at a time; neither side is ever in
one place. Of equal vectors only the k + 1 with the smallest ids take part as candidates: a further
copy could only come after these, whatever the query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import Scratch, broadcast_if_few

K = 10
LISTS = 2
SCALE = 1024
BLOCK = 4096
QUERIES = 16_384
#: Products that a task holds at once.
PRODUCTS = 1 << 22

#: Products are summed in double precision while they stay exact in it.
EXACT = float(1 << 53)


def quantised(embeddings: DataFrame) -> DataFrame:
    """``vec_id, v``: floor(1024 x) of every component as long.

    Left out are null ids, null vectors and vectors with a null or non-finite component.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    v = F.transform(x, lambda e: F.floor(e * F.lit(float(SCALE))).cast("long"))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(finite)
        .select(F.col("vec_id").cast("long"), v.alias("v"))
    )


def _blocks(rows: DataFrame, id_: str, scratch: Scratch, block: int) -> tuple[DataFrame, int]:
    """``block, list, ids, parts``: rows in blocks, one row for each list's components."""
    n = max(1, -(-rows.count() // block))
    # Vectors of different length are never compared; a block has one length.
    put = rows.select(
        id_, "v", F.size("v").alias("dims"), F.pmod(F.xxhash64(id_), F.lit(n)).cast("int").alias("block")
    )
    width = F.ceil(F.col("dims") / LISTS).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(LISTS - 1)),
        lambda k: F.slice("v", k * F.greatest(width, F.lit(1)) + 1, F.greatest(width, F.lit(1))),
    )
    gathered = (
        put.select(id_, "dims", "block", F.posexplode(parts).alias("list", "part"))
        .groupBy("block", "dims", "list")
        .agg(F.collect_list(F.struct(F.col(id_).alias("id"), "part")).alias("rows"))
    )
    return scratch.store(
        gathered.select("block", "dims", "list", F.col("rows.id").alias("ids"), F.flatten("rows.part").alias("parts"))
    ), n


def _products(queries: tuple, rows: tuple) -> np.ndarray:
    q = np.asarray(queries[1], dtype=np.int64).reshape(len(queries[0]), -1)
    v = np.asarray(rows[1], dtype=np.int64).reshape(len(rows[0]), -1)
    if not q.size or not v.size:
        return np.zeros((len(q), len(v)), dtype=np.int64)
    most = float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1]
    if most < EXACT:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q @ v.T


def _met(queries: DataFrame, n_queries: int, rows: DataFrame, n_rows: int) -> DataFrame:
    """Every block of queries beside every block of rows, list by list."""
    left = queries.select(
        F.col("block").alias("q_block"), "dims", "list", F.col("ids").alias("q_ids"), F.col("parts").alias("q_parts"),
        *[c for c in queries.columns if c == "cutoffs"],
        F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("block"),
    )
    right = rows.select("block", "dims", "list", "ids", "parts", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("q_block"))
    return left.join(right.hint("shuffle_hash"), ["q_block", "block", "dims", "list"])


def _scores(r):
    """Parts of the queries of a pair of blocks: their row numbers, places, scores, and which scores are their own."""
    ids, q_ids = np.asarray(r.ids), np.asarray(r.q_ids)
    q_parts = np.asarray(r.q_parts).reshape(len(q_ids), -1)
    step = max(1, PRODUCTS // max(len(ids), 1))
    for at in range(0, len(q_ids), step):
        some = slice(at, at + step)
        yield q_ids[some], some, _products((q_ids[some], q_parts[some]), (ids, r.parts)), q_ids[some, None] == ids[None, :]


def _best_of_list(k: int):
    def run(batches):
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids = np.asarray(r.ids)
                for q_ids, _, scores, own in _scores(r):
                    scores[own] = np.iinfo(np.int64).min
                    some = min(k + 1, scores.shape[1])
                    at = np.argpartition(-scores, some - 1, axis=1)[:, :some]
                    keep = ~np.take_along_axis(own, at, axis=1)
                    yield pd.DataFrame(
                        {
                            "query": np.repeat(q_ids, keep.sum(axis=1)),
                            "list": r.list,
                            "row": ids[at][keep],
                            "partial": np.take_along_axis(scores, at, axis=1)[keep],
                        }
                    )

    return run


def _over_threshold(batches):
    for batch in batches:
        for r in batch.itertuples(index=False):
            ids = np.asarray(r.ids)
            enough = -(-np.asarray(r.cutoffs, dtype=np.int64) // LISTS)
            for q_ids, some, scores, own in _scores(r):
                q, v = np.nonzero((scores >= enough[some, None]) & ~own)
                yield pd.DataFrame({"query": q_ids[q], "row": ids[v], "list": r.list, "partial": scores[q, v]})


def _score(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


def top_k(
    embeddings: DataFrame, is_query: Column, k: int = K, *, block: int = BLOCK, query_block: int = QUERIES, seen: dict | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of all other rows for each query.

    Queries are the rows of ``embeddings`` (vec_id, embedding) for which ``is_query`` holds.
    Equal scores rank the smaller vec_id first; fewer than ``k`` candidates are all returned.
    Rows are rows: of several with one vec_id each is a candidate, and each query, for itself.
    Only vectors of the query's length are its candidates. See ``quantised`` for rows that take
    no part. Scores must fit into a long. Empty tables give no rows; other columns are not read.
    ``seen`` takes the numbers of pairs that phase 2 gave and that phase 3 scored.
    """
    work = Scratch(embeddings.sparkSession, "top-k")
    vectors = work.store(quantised(embeddings))
    vectors = work.store(vectors.withColumn("row", F.monotonically_increasing_id()))
    queries = work.store(vectors.where(is_query).withColumnsRenamed({"vec_id": "query_id", "row": "query"}))
    copy = Window.partitionBy("v").orderBy("vec_id", "row")
    candidates = work.store(
        vectors.withColumn("copy", F.row_number().over(copy)).where(F.col("copy") <= k + 1).drop("copy")
    )
    query_blocks, n_queries = _blocks(queries, "query", work, query_block)
    row_blocks, n_rows = _blocks(candidates, "row", work, block)

    def scored(pairs: DataFrame) -> DataFrame:
        own = queries.select("query", F.col("v").alias("q"))
        return pairs.join(own, "query").join(candidates, "row").select("query", "row", _score(F.col("q"), F.col("v")).alias("score"))

    def ranked(scores: DataFrame) -> DataFrame:
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def kth(scores: DataFrame) -> DataFrame:
        """A score that k vectors reach; far below all where there are fewer."""
        order = Window.partitionBy("query").orderBy(F.desc("score"))
        best = scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = best.groupBy("query").agg(F.max("rank").alias("n"), F.min("score").alias("kth"))
        return queries.select("query").join(best, "query", "left").select(
            "query", F.when(F.col("n") == k, F.col("kth")).otherwise(F.lit(-(1 << 62))).alias("cutoff")
        )

    # 1. Local lists and the cutoff.
    met = _met(query_blocks, n_queries, row_blocks, n_rows)
    local = met.mapInPandas(_best_of_list(k), "query long, list int, row long, partial long")
    in_list = Window.partitionBy("query", "list").orderBy(F.desc("partial"), "row")
    first = local.withColumn("place", F.row_number().over(in_list)).where(F.col("place") <= k).select("query", "row").distinct()
    first = work.store(scored(first))
    cutoffs = work.store(kth(first))

    # 2. Every vector that some list puts at the threshold or above.
    # Each list holds a block's queries in an order of its own, so each has its own cutoffs.
    by_id = query_blocks.select("block", "dims", "list", F.posexplode("ids").alias("at", "query"))
    in_order = (
        by_id.join(broadcast_if_few(cutoffs), "query")
        .groupBy("block", "dims", "list")
        .agg(F.array_sort(F.collect_list(F.struct("at", "cutoff")))["cutoff"].alias("cutoffs"))
    )
    sent = query_blocks.join(in_order, ["block", "dims", "list"])
    given = _met(sent, n_queries, row_blocks, n_rows).mapInPandas(_over_threshold, "query long, row long, list int, partial long")
    given = work.store(given.groupBy("query", "row").agg(F.sum("partial").alias("score"), F.count("*").alias("lists")))
    known = given.where(F.col("lists") == LISTS).select("query", "row", "score").union(first).distinct()
    known = work.store(known)
    second = work.store(kth(known).withColumnRenamed("cutoff", "second"))
    # The least whole number of t / LISTS; a list that does not give the vector has less.
    enough = F.expr(f"(cutoff + pmod(-cutoff, {LISTS})) div {LISTS}")
    left = (
        given.where(F.col("lists") < LISTS)
        .join(broadcast_if_few(cutoffs), "query")
        .join(broadcast_if_few(second), "query")
        .where(F.col("score") + (LISTS - F.col("lists")) * (enough - 1) >= F.col("second"))
        .select("query", "row")
        .join(first, ["query", "row"], "left_anti")
    )

    # 3. Exact scores of those.
    left = work.store(left)
    if seen is not None:
        seen |= {"given": given.count(), "scored": left.count(), "known": known.count()}
    every = known.union(scored(left)).join(candidates.select("row", "vec_id"), "row")
    return ranked(every).join(queries.select("query", "query_id"), "query").select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score"
    )
